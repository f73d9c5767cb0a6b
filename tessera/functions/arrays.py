"""Column -> Column numeric array functions.

Array higher-order functions (transform / aggregate / zip_with) keep per-row
vector math on the JVM, inside codegen, without a Python UDF; only
``positions`` and ``joined`` look up a whole batch in Arrow.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def arr_sum(arr) -> Column:
    return F.aggregate(_c(arr), F.lit(0.0).cast("double"), lambda a, x: a + x)


def arr_mean(arr) -> Column:
    return arr_sum(arr) / F.size(_c(arr))


def dot(a, b) -> Column:
    return arr_sum(F.zip_with(_c(a), _c(b), lambda x, y: x * y))


def add(a, b) -> Column:
    return F.zip_with(_c(a), _c(b), lambda x, y: x + y)


def scale(arr, a: float, b: float) -> Column:
    """Affine map x -> a*x + b over an array."""
    return F.transform(_c(arr), lambda x: x * a + b)


def to_unit_range(arr) -> Column:
    """(x - 0.5) / 0.5 and its inverse are ``scale(arr, 2, -1)`` / ``scale(arr, .5, .5)``."""
    return scale(arr, 2.0, -1.0)


def to_uint8(arr) -> Column:
    """255*x + 0.5 clamped to [0, 255], truncated to an integer."""
    return F.transform(_c(arr), lambda x: F.least(F.greatest(x * 255 + 0.5, F.lit(0.0)),
                                                  F.lit(255.0)).cast("int"))


def softmax(arr) -> Column:
    """Max-shifted softmax of one vector."""
    a = _c(arr)
    m = F.array_max(a)
    e = F.transform(a, lambda x: F.exp(x - m))
    s = arr_sum(e)
    return F.transform(e, lambda x: x / s)


def log_softmax(arr) -> Column:
    a = _c(arr)
    m = F.array_max(a)
    lse = F.log(arr_sum(F.transform(a, lambda x: F.exp(x - m)))) + m
    return F.transform(a, lambda x: x - lse)


def sigmoid(arr) -> Column:
    return F.transform(_c(arr), lambda x: 1.0 / (1.0 + F.exp(-x)))


def tanh(arr) -> Column:
    return F.transform(_c(arr), lambda x: F.tanh(x))


def relu(arr) -> Column:
    return F.transform(_c(arr), lambda x: F.greatest(x, F.lit(0.0)))


def argmax(arr) -> Column:
    """0-based index of the maximum, first index on ties."""
    a = _c(arr)
    return (F.array_position(a, F.array_max(a)) - 1).cast("int")


def between_span(s1, e1, s2, e2) -> Column:
    """Context between two spans [s1,e1) and [s2,e2);
    empty (start >= end) when adjacent or overlapping.
    Returns struct(start, end)."""
    s1, e1, s2, e2 = map(_c, (s1, e1, s2, e2))
    start = F.when(e1 < s2, e1).otherwise(e2)
    end = F.when(e1 < s2, s2).otherwise(s1)
    return F.struct(start.alias("start"), end.alias("end"))


def span_mask(start, end, n) -> Column:
    """C20: array<boolean> over positions 0..n-1, true inside [start, end)."""
    n = F.greatest(_c(n), F.lit(0))
    s = F.least(F.greatest(_c(start), F.lit(0)), n)
    e = F.least(F.greatest(_c(end), s), n)
    return F.concat(F.array_repeat(F.lit(False), s), F.array_repeat(F.lit(True), e - s), F.array_repeat(F.lit(False), n - e))


def position_simple(k: int, m: int) -> Column:
    """C26 simple form: row p of a K x M table is p / K repeated M times.
    Returns array<array<double>>."""
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)),
                       lambda p: F.array_repeat((p / F.lit(float(k))).cast("double"), m))


def position_sinusoid(k: int, m: int) -> Column:
    """C26 sinusoid: alpha = floor(2*floor(i/2)/M) is 0 for every i < M, so
    even dims are sin(p), odd dims cos(p) (the reference's formula as written).
    Returns array<array<double>>."""
    def row(p):
        return F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda i: F.when(
            i % 2 == 0,
            F.sin(p / F.pow(F.lit(10000.0), F.floor(2 * F.floor(i / 2) / m)))).otherwise(
            F.cos(p / F.pow(F.lit(10000.0), F.floor(2 * F.floor(i / 2) / m)))))
    return F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda p: row(p.cast("double")))


def layer_norm(arr, gamma: float = 1.0, beta: float = 0.0, eps: float = 1e-10) -> Column:
    """H3: (x - mean) / (population sd + eps) * gamma + beta; eps is added
    outside the square root."""
    a = _c(arr)
    # one fold for (sum, sum of squares); population variance
    st = F.aggregate(a, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("q")),
                     lambda acc, x: F.struct((acc["s"] + x).alias("s"), (acc["q"] + x * x).alias("q")))
    n = F.size(a)
    mu = st["s"] / n
    sd = F.sqrt(F.greatest(st["q"] / n - mu * mu, F.lit(0.0)))
    return F.transform(a, lambda x: (x - mu) / (sd + eps) * gamma + beta)


def normalize_features(arr) -> Column:
    """Subtract the row minimum, divide by the row sum clamped to >= 1."""
    a = _c(arr)
    mn = F.array_min(a)
    shifted = F.transform(a, lambda x: x - mn)
    s = F.greatest(arr_sum(shifted), F.lit(1.0))
    return F.transform(shifted, lambda x: x / s)


def matvec(w: list[list[float]], x, b: list[float] | None = None) -> Column:
    """H4: W x + b with literal weights (rows of W), W small and fixed."""
    xs = _c(x)
    rows = []
    for i, wr in enumerate(w):
        v = dot(F.array(*[F.lit(float(v)) for v in wr]), xs)
        if b is not None:
            v = v + float(b[i])
        rows.append(v)
    return F.array(*rows)


def pad_to(arr, n, fill=0) -> Column:
    """Right-pad an array to length n with ``fill``."""
    a = _c(arr)
    k = F.greatest(_c(n) - F.size(a), F.lit(0))
    return F.concat(a, F.array_repeat(F.lit(fill).cast(_elem_type_hint(fill)), k))


def _elem_type_hint(fill) -> str:
    return "double" if isinstance(fill, float) else "int"


def round_arr(arr, digits: int = 6) -> Column:
    return F.transform(_c(arr), lambda x: F.round(x, digits))


SQRT = math.sqrt


#: Sums that one growing list of ``prefix_sums`` holds.
SUMS_RUN = 16


def prefix_sums(arr) -> Column:
    """Running sums of an int array as an array, in one fold inside the row. Lists are
    copied when they grow, so finished runs of SUMS_RUN sums are put aside: the cost of
    an element does not grow with the array (beyond one copy of a reference a run).
    Reference the result by column, never from inside another lambda (Spark would
    re-evaluate it per element)."""
    none, nothing = F.array().cast("array<long>"), F.array().cast("array<array<long>>")
    start = F.struct(nothing.alias("done"), none.alias("run"), F.lit(0).cast("long").alias("last"))

    def step(acc, x):
        last = (acc["last"] + x).cast("long")
        run = F.concat(acc["run"], F.array(last))
        full = F.size(acc["run"]) >= SUMS_RUN - 1
        return F.struct(F.when(full, F.concat(acc["done"], F.array(run))).otherwise(acc["done"]).alias("done"),
                        F.when(full, none).otherwise(run).alias("run"), last.alias("last"))

    return F.aggregate(_c(arr), start, step, lambda acc: F.flatten(F.concat(acc["done"], F.array(acc["run"]))))


def positions(listed, asked, last: bool = False) -> Column:
    """Where each element of the array ``asked`` is first (or last) equal to one of the array ``listed``, from 0; null if nowhere
    or for a null element. Elements are numbers, strings or structs of them (null fields are alike). All rows of a batch
    are looked up at once in one sorted list: an element costs a search, not a scan of the array."""
    side = "right" if last else "left"

    @F.arrow_udf("array<int>")
    def find(listed: pa.Array, asked: pa.Array) -> pa.Array:
        import numpy as np

        def rows(lists):
            size = np.diff(lists.offsets.to_numpy()) if len(lists) else np.zeros(0, np.int64)
            size = np.where(np.asarray(lists.is_valid()), size, 0)
            return lists.flatten(), size, np.repeat(np.arange(len(lists)), size)

        (x, x_size, x_row), (y, y_size, y_row) = rows(listed), rows(asked)
        both = pa.concat_arrays([x, y])
        code = np.concatenate((x_row, y_row)).astype(np.int64)
        for field in both.flatten() if pa.types.is_struct(both.type) else [both]:
            value = field.dictionary_encode("encode").indices.to_numpy(zero_copy_only=False).astype(np.int64)
            code = np.unique(code * (int(value.max(initial=0)) + 1) + value, return_inverse=True)[1]
        valid = np.asarray(both.is_valid())
        at = np.flatnonzero(valid[:len(x)])
        at = at[np.argsort(code[at], kind="stable")]
        have, want = code[at], code[len(x):]
        k = np.searchsorted(have, want, side) - (side == "right")
        hit = np.clip(k, 0, max(len(have) - 1, 0))
        ok = valid[len(x):] & (k >= 0) & (k < len(have))
        if len(have):
            ok &= have[hit] == want
        begin = np.concatenate(([0], np.cumsum(x_size)))
        place = (at[hit] - begin[y_row]) if len(have) else np.zeros(len(y), np.int64)
        found = pa.array(place.astype(np.int32), mask=~ok)
        ends = np.concatenate(([0], np.cumsum(y_size))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends, mask=np.append(~np.asarray(asked.is_valid()), False)), found)

    return find(_c(listed), _c(asked))


#: Elements that ``joined`` looks up at once.
JOINED_AT_ONCE = 1_000_000


def joined(left, right, on: tuple[str, str], take: dict[str, str], kind: str, outer: bool = False) -> Column:
    """The equi-join of two lists of structs in the row: each element of ``left`` once for each element of ``right`` whose int field on[1] equals its
    on[0], by the places of both, with right's fields ``take`` (name: field) besides its own; ``outer``: also one without any. ``kind`` is
    the type of the result's structs. Null lists are empty. Runs of rows of a batch are looked up at once in one sorted list."""
    most, (l_on, r_on), taken = JOINED_AT_ONCE, on, list(take.values())

    @F.arrow_udf(f"array<{kind}>")
    def find(left: pa.Array, right: pa.Array) -> pa.Array:
        import numpy as np
        n = len(left)
        size = lambda x: np.where(np.asarray(x.is_valid()), np.diff(x.offsets.to_numpy()), 0) if n else np.zeros(0, np.int64)
        ends = np.cumsum(size(left) + size(right))
        out, at = [], 0
        while at < n or not out:
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
            out.append(_joined(left.slice(at, upto - at), right.slice(at, upto - at), l_on, r_on, taken, names, outer))
            at = upto
        return pa.concat_arrays(out)

    names = T.StructType.fromDDL(f"z {kind}")["z"].dataType.names
    return find(_c(left), _c(right))


def _joined(left, right, l_on: str, r_on: str, taken: list[str], names: list[str], outer: bool):
    import numpy as np

    def rows(lists, on):
        size = np.where(np.asarray(lists.is_valid()), np.diff(lists.offsets.to_numpy()), 0) if len(lists) else np.zeros(0, np.int64)
        fields = dict(zip([f.name for f in lists.type.value_type], lists.flatten().flatten()))
        x = fields[on]
        return fields, x.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), np.asarray(x.is_valid()), np.repeat(np.arange(len(lists)), size)

    (own, y, y_is, y_row), (other, x, x_is, x_row) = rows(left, l_on), rows(right, r_on)
    low = min(x.min(initial=0), y.min(initial=0))
    wide = max(x.max(initial=0), y.max(initial=0)) - low + 1
    place = np.flatnonzero(x_is)
    have = (x_row * wide + x - low)[place]
    order = np.argsort(have, kind="stable")
    have, place = have[order], place[order]
    want = y_row * wide + y - low
    first = np.searchsorted(have, want)
    n = np.where(y_is, np.searchsorted(have, want, "right") - first, 0)
    each = np.maximum(n, 1) if outer else n
    who = np.repeat(np.arange(len(want)), each)
    none = n[who] == 0
    at = first[who] + np.arange(len(who)) - np.repeat(np.cumsum(each) - each, each)
    k = np.zeros(len(who), np.int64)
    k[~none] = place[at[~none]]
    who_at, k_at = pa.array(who), pa.array(k, mask=none)
    found = pa.StructArray.from_arrays([*[own[c].take(who_at) for c in own], *[other[c].take(k_at) for c in taken]], names)
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(y_row[who], np.arange(len(left) + 1)).astype(np.int32)), found)
