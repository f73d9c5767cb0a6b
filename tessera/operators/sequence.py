"""Token sequences and ordered folds.

A recurrent fold is sequential within one series. Rows are dealt by series and
sorted; a task streams them and folds all series of a batch of rows at once,
step by step, as matrices. The state of the series that a batch ends in is
carried to the next batch, so a series may be of any length and no series is
ever held as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import ship

# The arithmetic-expression vocabulary in index order.
SPECIAL_TOKENS = ["POSITIVE", "NEGATIVE", "add", "subtract", "BOS", "EOS"]
VOCAB_ORDER = [str(d) for d in range(10)] + SPECIAL_TOKENS


def build_vocab(tokens: DataFrame, col: str = "token", order=VOCAB_ORDER) -> DataFrame:
    """Token -> index for every distinct token: those of ``order`` have their place in it, all others
    follow it in their own order. No token is left out."""
    from tessera.operators.splits import global_rank
    d = tokens.select(col).filter(F.col(col).isNotNull()).distinct()
    arr = F.array(*[F.lit(t) for t in order])
    known = d.filter(F.col(col).isin(*order)).select(col, (F.array_position(arr, F.col(col)) - 1).cast("int").alias("idx"))
    rest = global_rank(d.filter(~F.col(col).isin(*order)), [F.col(col)], "_r")
    return known.unionByName(rest.select(col, (F.col("_r") + len(order)).cast("int").alias("idx")))


def split_tokens(expr: Column, specials=SPECIAL_TOKENS) -> Column:
    """C24 tokenization: whitespace split; special tokens whole, others per
    character."""
    sp = F.array(*[F.lit(t) for t in specials])
    return F.flatten(F.transform(F.split(expr, " "), lambda t: F.when(
        F.array_contains(sp, t), F.array(t)).otherwise(F.split(t, ""))))


def encode_sequence(expr: Column, order=VOCAB_ORDER) -> Column:
    """Ids; an unknown token raises an error (as the reference does)."""
    m = F.create_map(*[x for i, t in enumerate(order) for x in (F.lit(t), F.lit(i))])
    return F.transform(split_tokens(expr), lambda t: F.coalesce(
        F.try_element_at(m, t), F.raise_error(F.concat(F.lit("unknown token: "), t)).cast("int")))


def decode_sequence(ids: Column, order=VOCAB_ORDER, eos: str = "EOS") -> Column:
    """Ids -> tokens up to (not including) the first EOS."""
    arr = F.array(*[F.lit(t) for t in order])
    toks = F.transform(ids, lambda i: F.element_at(arr, i + 1))
    p = F.array_position(toks, F.lit(eos))
    return F.when(p > 0, F.slice(toks, 1, p - 1)).otherwise(toks)


def shift_target(ids: Column):
    """(input ids[:-1], gold ids[1:])."""
    n = F.size(ids)
    return F.slice(ids, 1, n - 1), F.slice(ids, 2, n - 1)


def token_accuracy(df: DataFrame, gold: str, pred: str) -> DataFrame:
    """Correct tokens over all tokens of all sequences (the reference
    reports the last batch's correct count over all tokens; this is the
    intended ratio)."""
    z = df.select(F.explode(F.arrays_zip(F.col(gold).alias("g"), F.col(pred).alias("p"))).alias("z"))
    return z.agg(F.count_if(F.col("z.g") == F.col("z.p")).alias("correct"), F.count(F.lit(1)).alias("total")) \
            .withColumn("accuracy", F.col("correct") / F.col("total"))


def _fold(batches, keys: list[str], step, states: list[int], outs: int, types):
    """Batches of rows (keys, _x) in order of series and step -> batches of (keys, step, outputs). ``step(x, *state)``
    takes one row a series and gives (state, outputs). The last series of a batch goes on in the next."""
    import numpy as np
    import pyarrow as pa
    last, carried, count = None, None, 0
    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in keys]
        ids = list(zip(*cols))
        starts = np.array([0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1])])
        lengths = np.diff([*starts, len(ids)])
        x = batch.column("_x")
        x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(ids), -1)
        state = [np.zeros((len(starts), n)) for n in states]
        first = np.zeros(len(starts), dtype=np.int64)
        if last is not None and ids[0] == last:
            first[0] = count
            for s, c in zip(state, carried):
                s[0] = c
        order = np.argsort(-lengths, kind="stable")   # long series first: those still open are a prefix
        results = [None] * outs
        for t in range(int(lengths.max())):
            now = order[:np.searchsorted(-lengths[order], -t, "left")]
            new, out = step(x[starts[now] + t], *[s[now] for s in state])
            for s, n in zip(state, new):
                s[now] = n
            for j, o in enumerate(out):
                if results[j] is None:
                    results[j] = np.empty((len(ids), o.shape[1]))
                results[j][starts[now] + t] = o
        steps = np.arange(len(ids)) - np.repeat(starts, lengths) + np.repeat(first, lengths)
        last, carried, count = ids[-1], [s[-1] for s in state], int(steps[-1]) + 1
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keys), pa.array(steps), *(pa.array(list(r), pa.list_(pa.float64())) for r in results)], types)


def _scan(rows: DataFrame, keys: list[str], order: list[str], x: str, step, states: list[int], names: list[str]) -> DataFrame:
    d = rows.select(*keys, *order, F.col(x).cast("array<double>").alias("_x")).repartition(*keys)
    d = d.sortWithinPartitions(*keys, *[c for c in order if c not in keys]).select(*keys, "_x")
    types = [*keys, "step", *names]
    schema = ", ".join([*(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in keys), "step long", *(f"{n} array<double>" for n in names)])
    return ship(d).mapInArrow(lambda it: _fold(it, keys, step, states, len(names), types), schema)


def _softmax(z):
    import numpy as np
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def rnn_scan(rows: DataFrame, keys: list[str], order: list[str], x: str, params: dict) -> DataFrame:
    """For every step of every series (keys, step, a, y): a = tanh(Waa a' + Wax x + ba), y = softmax(Wya a + by);
    a' is the state before, zero at first. ``x`` is a vector; ``params``: Waa, Wax, ba, Wya, by."""
    import numpy as np
    w = {k: np.asarray(v, dtype=float) for k, v in params.items()}

    def step(xt, a):
        a = np.tanh(a @ w["Waa"].T + xt @ w["Wax"].T + w["ba"])
        return (a,), (a, _softmax(a @ w["Wya"].T + w["by"]))

    return _scan(rows, keys, order, x, step, [len(w["ba"])], ["a", "y"])


def lstm_scan(rows: DataFrame, keys: list[str], order: list[str], x: str, params: dict) -> DataFrame:
    """For every step of every series (keys, step, a, c, y): gates over [a', x] (f forget, i update, o output: sigmoid;
    candidate tanh), c = f c' + i candidate, a = o tanh(c), y = softmax(Wy a + by); a' and c' are zero at
    first. ``params``: Wf, bf, Wi, bi, Wc, bc, Wo, bo, Wy, by."""
    import numpy as np
    w = {k: np.asarray(v, dtype=float) for k, v in params.items()}
    sigmoid = lambda z: 1.0 / (1.0 + np.exp(-z))

    def step(xt, a, c):
        ax = np.concatenate([a, xt], axis=1)
        f, i, o = (sigmoid(ax @ w["W" + g].T + w["b" + g]) for g in "fio")
        c = f * c + i * np.tanh(ax @ w["Wc"].T + w["bc"])
        a = o * np.tanh(c)
        return (a, c), (a, c, _softmax(a @ w["Wy"].T + w["by"]))

    n = len(w["bf"])
    return _scan(rows, keys, order, x, step, [n, n], ["a", "c", "y"])


def ewma(rows: DataFrame, keys: list[str], order: list[str], value: str, beta1: float = 0.9, beta2: float = 0.999) -> DataFrame:
    """Bias-corrected first and second moments (Adam's m and v) of each series after its last element:
    (keys, m_hat, v_hat). An element's weight is (1 - beta) beta^k with k elements after it, so the moments are
    sums over ranked rows; no series is gathered."""
    from pyspark.sql import Window
    w = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order])
    d = rows.select(*keys, F.col(value).cast("double").alias("_g"), (F.row_number().over(w) - 1).alias("_k"))
    n = F.count(F.lit(1))
    m = F.sum(F.col("_g") * F.pow(F.lit(beta1), F.col("_k"))) * (1 - beta1)
    v = F.sum(F.col("_g") * F.col("_g") * F.pow(F.lit(beta2), F.col("_k"))) * (1 - beta2)
    return d.groupBy(*keys).agg((m / (1 - F.pow(F.lit(beta1), n))).alias("m_hat"), (v / (1 - F.pow(F.lit(beta2), n))).alias("v_hat"))
