"""Periods, line rules and repair: held against brute force; odd rows and empty tables."""

import functools
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tests.llm.conftest import ROWS

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def slow_runs(w, least=6, repeats=4):
    """All (start, length, period) by trying every period."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            x = w[i:j + q]
            if len(x) >= max(least, repeats * q) and not any(x[r:] == x[:-r] for r in range(1, q)):
                out.append((i, len(x), q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    w = [rng.randrange(rng.choice([1, 2, 3, 5])) for _ in range(rng.randint(0, 40))]
    if w and rng.random() < 0.5:
        w += [rng.randrange(4) for _ in range(rng.randint(1, 7))] * rng.randint(2, 6) + w[:rng.randint(0, 5)]
    return w


def test_runs_against_every_period():
    from tessera.llm.periodicity import document_runs, runs_of
    from tessera.llm.words import parts
    rng = random.Random(3)
    for _ in range(600):
        docs = [some_words(rng) for _ in range(rng.randint(1, 4))]
        for least, repeats in ((6, 4), (4, 2), (9, 3)):
            for _, ids, begins in parts((i, [b"%d" % x for x in w]) for i, w in enumerate(docs)):
                assert document_runs(ids, begins, least, repeats) == [slow_runs(w, least, repeats) for w in docs]
        if docs[0]:
            assert [tuple(r) for r in runs_of(np.array(docs[0]), 2, 2).tolist()] == slow_runs(docs[0], 2, 2)


def test_extensions_against_comparison():
    from tessera.llm.periodicity import Extensions
    rng = random.Random(5)
    for _ in range(60):
        s = np.array([rng.randint(1, 3) for _ in range(rng.randint(2, 60))])
        i, j = zip(*((a, b) for a in range(len(s)) for b in range(len(s)) if a != b))
        got = Extensions(s)(np.array(i), np.array(j))
        for a, b, n in zip(i, j, got):
            want = 0
            while max(a, b) + want < len(s) and s[a + want] == s[b + want]:
                want += 1
            assert n == want


def test_long_period_in_linear_time():
    from tessera.llm.periodicity import runs_of
    rng = np.random.default_rng(1)
    x = np.tile(rng.integers(5000, size=20_000), 5)
    assert runs_of(x).tolist() == [[0, 100_000, 20_000]]
    assert runs_of(np.zeros(50_000, dtype=np.int64)).tolist() == [[0, 50_000, 1]]


def _slow_periods(doc_id, text):
    words = WORD.findall(text or "")
    if doc_id is not None and words:
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0:
            g = h // 10
            a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = slow_runs(words)
    gone = {i for s, l, p in runs for i in range(s + p, s + l)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *best, None if best[0] is None else 1000 * best[1] // best[2],
            hashlib.sha256("".join(f"{s},{l},{p}\n" for s, l, p in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest())


def test_periods_query(spark, tmp_path):
    from tessera.llm.queries import QUERIES
    rng = random.Random(11)
    rows = [(i, " ".join(f"w{x}" for x in some_words(rng))) for i in range(400)] + [(None, "a a a a a a a"), (401, None), (402, ""), (403, " \t\n"), (404, "é x " * 9), (404, "é x " * 9)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'clash' runs", "'clash' n_words").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op11_periods"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(_slow_periods(*r) for r in rows)


def test_periods_odd_rows(odd, empty):
    from tessera.llm.periodicity import periodic_runs
    got = periodic_runs(odd).collect()
    assert Counter((r["doc_id"], r["n_words"]) for r in got) == Counter((i, len(WORD.findall(t or ""))) for i, t, _, _ in ROWS)
    assert all(r["runs"] == [] for r in got if not r["n_words"])
    assert periodic_runs(empty).count() == 0


def _slow_rules(rows, line_docs, line_percent):
    norm = lambda line: re.sub("[0-9]+", "0", " ".join(WORD.findall(line)).translate({c: c + 32 for c in range(65, 91)}))
    lines = [[x for x in (t or "").split("\n") if WORD.search(x)] for _, t, _, _ in rows]
    held, texts = defaultdict(set), defaultdict(set)
    for (_, t, _, host), own in zip(rows, lines):
        for x in own:
            held[host, norm(x)].add(t)
            texts[host].add(t)
    out = []
    for (doc_id, t, _, host), own in zip(rows, lines):
        words = WORD.findall(t or "")
        grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        repeat = len({i + k for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for k in range(5)})
        gone = sum(len(WORD.findall(x)) for x in own if len(held[host, norm(x)]) > line_docs and len(held[host, norm(x)]) * 100 > len(texts[host]) * line_percent)
        n = len(words)
        failed = n < 10 or 100 * repeat > 20 * n
        out.append((doc_id, n, sum(map(len, words)), sum(c in "#*$%&|<>" for c in t or ""), len(own) - len(set(own)), repeat, gone, failed,
                    not failed and 100 * (n - gone) >= 50 * n and n - gone >= 10))
    return out


RULES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_words", "base_failed", "kept"]


@pytest.fixture(scope="module")
def lined(spark):
    rng = random.Random(7)
    line = lambda: " ".join(f"{rng.choice(['Wort', 'x', 'é', '#1', 'a|b'])}{rng.randrange(40)}" for _ in range(rng.randint(3, 9)))
    shared = ["Cookie  notice 2020 all rights", "Menu home about us contact and more words here", line()]
    rows = []
    for i in range(160):
        own = [line() for _ in range(rng.randint(0, 5))] + [x.upper() if rng.random() < 0.3 else x for x in shared if rng.random() < 0.4]
        rng.shuffle(own)
        rows.append((i, "\n".join(own + own[:rng.randint(0, 1)]), "en", rng.choice(["a", "a", "b", None, ""])))
    rows += rows[:12] + [(500 + i, rows[5][1], "en", "a") for i in range(60)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").selectExpr("*", "'clash' host", "'clash' row", "'clash' words", "'clash' line")


@pytest.mark.parametrize("limits", [(20, 5), (3, 10), (0, 0)])
@pytest.mark.parametrize("broadcast", [0, 1000])
def test_line_rules_against_loops(lined, limits, broadcast):
    from tessera.llm.line_rules import judged
    rows, df = lined
    got = judged(df, *limits, broadcast_lines=broadcast).select(*RULES).collect()
    assert Counter(map(tuple, got)) == Counter(_slow_rules(rows, *limits))


def test_line_rules_odd_rows(odd, empty):
    from tessera.llm.line_rules import judged
    got = judged(odd).select(*RULES).collect()
    assert Counter(map(tuple, got)) == Counter(_slow_rules(ROWS, 20, 5))
    assert judged(empty).count() == 0


def slow_audit(rows):
    """(cost, audit) of rows (initial, must_go, truncated) by all edits, from the end."""
    then = {"": {"u": "u", "s": "s"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @functools.cache
    def best(i, state, inserted):
        ways = []
        if inserted < 3:
            ways += [(3, "I", best(i, then[state][c], inserted + 1)) for c in "ua" if c in then[state]]
        if i == len(rows):
            if state in ("", "a"):
                return (0, "")
        else:
            initial, must_go, cut = rows[i]
            ways.append((4, "D", best(i + 1, state, 0)))
            if not must_go:
                ways += [(3 + 3 * cut, "R", best(i + 1, then[state][c], 0)) for c in "ua" if c in then[state]]
                if initial in then[state]:
                    ways.append((3 * cut, "K", best(i + 1, then[state][initial], 0)))
        return min(((c + rest[0], e + rest[1]) for c, e, rest in ways), default=(10**9, ""))

    return best(0, "", 0)


def _audited(rows):
    from tessera.llm.repair import Repairer
    r, out, open_ = Repairer(), [], 0
    for row in rows:
        out += r.row(row, *row)
        open_ = max(open_, len(r.open))
    out += r.close()
    assert [item for _, item in out if item is not None] == rows
    return "".join(e for e, _ in out), open_


def test_repair_against_all_edits():
    rng = random.Random(13)
    for _ in range(3000):
        rows = [(rng.choice(["s", "u", "a", "u", "a", "t", ""]), rng.random() < 0.15, rng.random() < 0.2) for _ in range(rng.randint(0, 11))]
        assert _audited(rows)[0] == slow_audit(rows)[1], rows
    for initial in "sua":
        rows = [(initial, False, False)] * 30
        assert _audited(rows)[0] == slow_audit(rows)[1]


def test_repair_holds_only_what_is_open():
    rows = [("u", False, False), ("a", False, False)] * 20_000
    rows[777] = rows[7777] = ("u", True, True)
    audit, open_ = _audited(rows)
    assert len(audit) >= 40_000 and open_ < 20
    assert len(_audited([("u", True, False)] * 5000 + [("u", False, False)] * 5001)[0]) >= 10_001  # open ties of thousands of rows


def _slow_repair(conv, rows):
    """The contract's row of one conversation, from rows (turn, role, text) in order."""
    own, dropped = [], 0
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if way == 1 else re.sub("[.!?]", "", text) if way == 2 else text
        own += [(turn, "user" if way == 4 else role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults, seen = [], set()
    for _, role, text in own:
        said = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not said else "duplicate" if (role, text) in seen else None if said[-1] in ".!?" else "truncated")
        seen.add((role, text))
    cost, audit = slow_audit([(role[:1], f in ("blank", "duplicate"), f == "truncated") for (_, role, _), f in zip(own, faults)])
    turns = {t for t, _, _ in own if t is not None}
    out, left, state = [], list(own), ""
    for e in audit:
        turn = "a" if state == "u" else "u"
        _, role, text = left.pop(0) if e != "I" else (None, None, "")
        if e == "D":
            continue
        role = role if e == "K" else {"u": "user", "a": "assistant"}[turn]
        state = role[:1]
        out.append(f"{role}:{text}")
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def test_repair_query(spark, tmp_path):
    from tessera.llm.queries import QUERIES
    rng = random.Random(17)
    text = lambda: rng.choice(["Hello there.", "Why?", "cut off", "", " \n", None, "Same.", "Né  so!", "a" * 50_000 + "."])
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, *range(12)]), rng.choice(["user", "assistant", "system", "tool", None, ""]), text()) for _ in range(900)]
    rows += [(c, 0, "user", "Gone.") for c in range(100, 160)] + rows[:40]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'clash' way", "'clash' fault", "'clash' dropped", "'clash' repeated")
    df.write.parquet(str(tmp_path / "conversations.parquet"))
    by = defaultdict(list)
    for c, *r in rows:
        by[c].append(r)
    got = QUERIES["op13_repair"](spark, str(tmp_path))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert Counter(map(tuple, got.collect())) == Counter(_slow_repair(c, own) for c, own in by.items())


def test_repair_interface(spark):
    from tessera.llm.repair import repaired
    rows = [(1, 0, "user", "Hi."), (1, 1, "user", "Still there?"), (1, 2, "assistant", "Yes."), (2, 0, "system", "Be kind.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in repaired(df).select("conv_id", "step", "edit", "role", "text", "cost").orderBy("conv_id", "step").collect()]
    assert got == [(1, 0, "K", "user", "Hi.", 0), (1, 1, "I", "assistant", "", 3), (1, 2, "K", "user", "Still there?", 0),
                   (1, 3, "K", "assistant", "Yes.", 0), (2, 0, "D", None, "Be kind.", 4)]
    assert repaired(df.limit(0)).count() == 0
    plan = repaired(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


def test_line_rules_sql(lined):
    import duckdb
    import pandas as pd

    from tessera.llm.line_rules import RULES_SQL
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(lined[0], columns=["doc_id", "text", "lang", "source"]))
    got = con.sql(RULES_SQL).select(", ".join(RULES)).fetchall()
    assert Counter(got) == Counter(_slow_rules(lined[0], 20, 5))
