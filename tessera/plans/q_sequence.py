"""C23-C26, E21, H13, H14, H17 over sequences derived from events."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import sequence as Q
from tessera.plans.registry import query
from tessera.session import table


def expressions(spark, sf):
    """'BOS <sign> dddd <op> <sign> dddd EOS' from event ids."""
    ev = table(spark, sf, "events").select("event_id")
    s1 = F.when(F.col("event_id") % 2 == 0, "POSITIVE").otherwise("NEGATIVE")
    s2 = F.when(F.col("event_id") % 3 == 0, "NEGATIVE").otherwise("POSITIVE")
    op = F.when(F.col("event_id") % 5 < 3, "add").otherwise("subtract")
    a = F.lpad((F.col("event_id") % 10000).cast("string"), 4, "0")
    c = F.lpad((F.col("event_id") * 7 % 10000).cast("string"), 4, "0")
    return ev.select("event_id", F.concat_ws(" ", F.lit("BOS"), s1, a, op, s2, c, F.lit("EOS")).alias("expr"))


EXPR_SQL = """SELECT event_id, concat_ws(' ', 'BOS', CASE WHEN event_id % 2 = 0 THEN 'POSITIVE' ELSE 'NEGATIVE' END,
  lpad(CAST(event_id % 10000 AS VARCHAR), 4, '0'), CASE WHEN event_id % 5 < 3 THEN 'add' ELSE 'subtract' END,
  CASE WHEN event_id % 3 = 0 THEN 'NEGATIVE' ELSE 'POSITIVE' END, lpad(CAST(event_id * 7 % 10000 AS VARCHAR), 4, '0'), 'EOS') AS expr
FROM events"""
_VOCAB = "['0', '1', '2', '3', '4', '5', '6', '7', '8', '9', 'POSITIVE', 'NEGATIVE', 'add', 'subtract', 'BOS', 'EOS']"
_TOKS = f"""flatten(list_transform(string_split(expr, ' '), lambda t: CASE WHEN list_contains({_VOCAB}[11:16], t)
  THEN [t] ELSE string_split(t, '') END))"""
IDS_SQL = f"SELECT event_id, list_transform({_TOKS}, lambda t: list_position({_VOCAB}, t) - 1) AS ids FROM ({EXPR_SQL})"


@query("c23_build_vocab", f"""
SELECT token, CAST(CASE WHEN list_contains({_VOCAB}, token) THEN list_position({_VOCAB}, token) - 1
  ELSE 15 + row_number() OVER (PARTITION BY list_contains({_VOCAB}, token) ORDER BY token) END AS INTEGER) AS idx FROM (
  SELECT unnest({_TOKS}) AS token FROM ({EXPR_SQL}) UNION
  SELECT token FROM (SELECT unnest(regexp_split_to_array(text, '\\s+')) AS token FROM documents) WHERE token <> '')""")
def c23(spark, sf):
    """The vocabulary of the expressions and of all words of the documents."""
    t = expressions(spark, sf).select(F.explode(Q.split_tokens(F.col("expr"))).alias("token"))
    w = table(spark, sf, "documents").select(F.explode(F.split("text", r"\s+")).alias("token")).filter("token <> ''")
    return Q.build_vocab(t.unionByName(w))


@query("c24_encode_sequence", f"""
SELECT event_id, array_to_string(ids, ',') AS ids, CAST(len(ids) AS INTEGER) AS n FROM ({IDS_SQL})""")
def c24(spark, sf):
    e = expressions(spark, sf).withColumn("ids", Q.encode_sequence(F.col("expr")))
    return e.select("event_id", F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"),
                    F.size("ids").alias("n"))


@query("c25_decode_sequence", f"""
SELECT event_id, array_to_string(list_transform(ids[1:list_position(ids, 15) - 1], lambda i: {_VOCAB}[i + 1]), ' ') AS text
FROM ({IDS_SQL})""")
def c25(spark, sf):
    e = expressions(spark, sf).withColumn("ids", Q.encode_sequence(F.col("expr")))
    return e.select("event_id", F.array_join(Q.decode_sequence(F.col("ids")), " ").alias("text"))


@query("c26_position_encoding", f"""
SELECT event_id, round(list_sum(list_transform(generate_series(0, len(ids) - 1), lambda p: 4 * p / len(ids))), 6) AS simple_sum,
       round(list_sum(list_transform(generate_series(0, len(ids) - 1), lambda p: 2 * sin(p) + 2 * cos(p))), 6) AS sin_sum
FROM ({IDS_SQL})""")
def c26(spark, sf):
    e = expressions(spark, sf).withColumn("ids", Q.encode_sequence(F.col("expr")))
    k = F.size("ids")
    m = 4
    pos = F.sequence(F.lit(0), k - 1)
    simple = F.transform(pos, lambda p: F.array_repeat((p / k).cast("double"), m))
    # alpha = floor(2*floor(i/2)/M) = 0 for i < M: even dims sin(p), odd dims cos(p)
    sinus = F.transform(pos, lambda p: F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda i: F.when(
        i % 2 == 0, F.sin(p / F.pow(F.lit(10000.0), F.floor(2 * F.floor(i / 2) / m))))
        .otherwise(F.cos(p / F.pow(F.lit(10000.0), F.floor(2 * F.floor(i / 2) / m))))))

    def total(a):
        return F.aggregate(F.flatten(a), F.lit(0.0), lambda s, x: s + x)
    return e.select("event_id", F.round(total(simple), 6).alias("simple_sum"), F.round(total(sinus), 6).alias("sin_sum"))


@query("e21_token_accuracy", f"""
SELECT count(*) FILTER (WHERE g = p) AS correct, count(*) AS total,
       round(count(*) FILTER (WHERE g = p) / count(*), 6) AS accuracy FROM (
  SELECT g, CASE WHEN (event_id + k) % 7 = 0 THEN (g + 1) % 16 ELSE g END AS p FROM (
    SELECT event_id, unnest(generate_series(1, len(ids) - 1)) AS k, unnest(ids[2:]) AS g FROM ({IDS_SQL})))""")
def e21(spark, sf):
    e = expressions(spark, sf).withColumn("ids", Q.encode_sequence(F.col("expr")))
    _, gold = Q.shift_target(F.col("ids"))
    e = e.withColumn("gold", gold)
    e = e.withColumn("pred", F.transform("gold", lambda g, k: F.when((F.col("event_id") + k + 1) % 7 == 0, (g + 1) % 16)
                                         .otherwise(g)))
    return Q.token_accuracy(e, "gold", "pred").select("correct", "total", F.round("accuracy", 6).alias("accuracy"))


#: A series: the events of a user on a day, in order; each gives a vector of two numbers.
SERIES, IN_SERIES = ["user_id", "day"], ["ts", "event_id"]


def _series(spark, sf):
    return table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("day"), "ts", "event_id", F.array(
        F.col("value") / 100, (F.col("event_id") % 10) / 10.0).alias("x"))


def _matrix(rows, cols, seed):
    return [[((i * cols + j + seed) % 7 - 3) / 5 for j in range(cols)] for i in range(rows)]


def _vector(n, seed):
    return [((i + seed) % 5 - 2) / 10 for i in range(n)]


#: Fixed weights: three units, two inputs, two classes.
RNN = {"Waa": _matrix(3, 3, 1), "Wax": _matrix(3, 2, 2), "ba": _vector(3, 0), "Wya": _matrix(2, 3, 4), "by": _vector(2, 1)}
LSTM = {f"{k}{g}": (_matrix(3, 5, n) if k == "W" else _vector(3, n)) for n, g in enumerate("fico") for k in "Wb"} | {"Wy": _matrix(2, 3, 5), "by": _vector(2, 3)}

_STEPS_SQL = """SELECT user_id, CAST(ts AS DATE) AS day, value / 100 AS x0, (event_id % 10) / 10.0 AS x1,
  row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) - 1 AS step FROM events"""


def _affine(w, b, names):
    return " + ".join([f"({v}) * {n}" for v, n in zip(w, names)] + [f"({b})"])


def _softmax_sql(z):
    top = f"greatest({', '.join(z)})"
    return [f"exp({v} - {top}) / ({' + '.join(f'exp({u} - {top})' for u in z)})" for v in z]


def _scan_sql(states, new, outs):
    """Steps one after the other: ``new`` gives each state by (state before, x), ``outs`` what is shown of it."""
    cols = ", ".join(states)
    first = ", ".join(f"{new(['0.0'] * len(states))[i]} AS {c}" for i, c in enumerate(states))
    more = ", ".join(f"{new([f's.{c}' for c in states])[i]} AS {c}" for i, c in enumerate(states))
    return f"""
WITH RECURSIVE e AS MATERIALIZED ({_STEPS_SQL}),
s AS (SELECT user_id, day, step, {first} FROM e WHERE step = 0
  UNION ALL SELECT e.user_id, e.day, e.step, {more} FROM s JOIN e ON e.user_id = s.user_id AND e.day = s.day AND e.step = s.step + 1)
SELECT user_id, day, step, {', '.join(f'round({v}, 6) AS {n}' for n, v in outs.items())} FROM (SELECT user_id, day, step, {cols} FROM s)"""


def _rnn_sql():
    a = ["a0", "a1", "a2"]
    new = lambda old: [f"tanh({_affine(RNN['Waa'][i] + RNN['Wax'][i], RNN['ba'][i], [*old, 'x0', 'x1'])})" for i in range(3)]
    y = _softmax_sql([f"({_affine(RNN['Wya'][i], RNN['by'][i], a)})" for i in range(2)])
    return _scan_sql(a, new, {n: n for n in a} | {f"y{i}": v for i, v in enumerate(y)})


def _lstm_sql():
    def new(old):
        gate = lambda g, i: _affine(LSTM["W" + g][i], LSTM["b" + g][i], [*old[:3], "x0", "x1"])
        sig = lambda z: f"(1.0 / (1.0 + exp(-({z}))))"
        c = [f"({sig(gate('f', i))} * {old[3 + i]} + {sig(gate('i', i))} * tanh({gate('c', i)}))" for i in range(3)]
        return [f"{sig(gate('o', i))} * tanh({c[i]})" for i in range(3)] + c
    names = ["a0", "a1", "a2", "c0", "c1", "c2"]
    y = _softmax_sql([f"({_affine(LSTM['Wy'][i], LSTM['by'][i], names[:3])})" for i in range(2)])
    return _scan_sql(names, new, {n: n for n in names} | {f"y{i}": v for i, v in enumerate(y)})


def _shown(scan, **widths):
    return scan.select(*SERIES, "step", *[F.round(F.element_at(c, i + 1), 6).alias(f"{c}{i}") for c, n in widths.items() for i in range(n)])


@query("h13_rnn_scan", _rnn_sql())
def h13(spark, sf):
    return _shown(Q.rnn_scan(_series(spark, sf), SERIES, IN_SERIES, "x", RNN), a=3, y=2)


@query("h14_lstm_scan", _lstm_sql())
def h14(spark, sf):
    return _shown(Q.lstm_scan(_series(spark, sf), SERIES, IN_SERIES, "x", LSTM), a=3, c=3, y=2)


_SERIES_SQL = """SELECT user_id, CAST(ts AS DATE) AS day, list(value / 100 ORDER BY ts, event_id) AS xs FROM events GROUP BY ALL"""


@query("h17_ewma", f"""
SELECT user_id, day, round(st[1] / (1 - pow(0.9, len(xs))), 6) AS m_hat, round(st[2] / (1 - pow(0.999, len(xs))), 6) AS v_hat FROM (
  SELECT user_id, day, xs, list_reduce(list_prepend([0.0, 0.0], list_transform(xs, lambda x: [x, 0.0])),
    lambda acc, g: [0.9 * acc[1] + 0.1 * g[1], 0.999 * acc[2] + 0.001 * g[1] * g[1]]) AS st FROM ({_SERIES_SQL}))""")
def h17(spark, sf):
    s = _series(spark, sf).withColumn("g", F.element_at("x", 1))
    return Q.ewma(s, SERIES, IN_SERIES, "g").select(*SERIES, F.round("m_hat", 6).alias("m_hat"), F.round("v_hat", 6).alias("v_hat"))
