"""Column -> Column string, label, file-name and date functions.

All are built-in expressions: they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values (labels, markers, token maps) --------------------------------
# Diagnosis normalisation: exact sets, then substring tests, in this order.
LABEL_RULES = [
    ("CN", ["CN", "NC", "SMC"], []),
    ("MCI", ["MCI", "EMCI", "LMCI"], ["MCI"]),
    ("AD", ["AD", "DEMENTIA"], ["DEMENT"]),
]
# Label order used for label -> index.
LABEL_ORDER = ["CN", "AD", "MCI"]
# Token replacements of two converters.
BRACKET_TOKENS = {"-LSB-": "[", "-RSB-": "]", "-LRB-": "(", "-RRB-": ")"}
COLUMN_CORPUS_TOKENS = {"COMMA": ",", "-LRB-": "(", "-RRB-": ")"}
# Special-case split of a glued token.
GLUED_SPECIAL = {"bisabolol-": ["bisabolol", "-"]}
# Marker strings removed from decoded text.
MARKERS = ["_start_", "_classify_", "<unk>", "⁇", "[CLS]", "[SEP]", "[PAD]"]
# Scan file name: ptid, exam date, tag (lazy, may hold dots), optional .gz.
FILENAME_RE = r"^(\d+_S_\d+)__(\d{4}-\d{2}-\d{2})__(.+?)\.csv(?:\.gz)?$"
# --------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def strip(col) -> Column:
    """Without white space (not spaces alone) at either end."""
    return F.regexp_replace(_c(col), r"^\s+|\s+$", "")


def normalize_label(col, rules=LABEL_RULES) -> Column:
    """B1: trim, upper, exact-set test then substring test per rule, in order;
    empty / unmatched -> null."""
    u = F.upper(strip(_c(col).cast("string")))
    out = None
    for label, exact, contains in rules:
        cond = u.isin(*exact)
        for s in contains:
            cond = cond | u.contains(s)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return F.when(u.isNull() | (u == ""), F.lit(None).cast("string")).otherwise(out)


def basename(col) -> Column:
    return F.regexp_extract(_c(col), r"([^/]*)$", 1)


def parse_filename(col, pattern: str = FILENAME_RE) -> Column:
    """B2: struct(ptid, date, tag, name) or null when the name does not match."""
    b = basename(col)
    ok = b.rlike(pattern)
    return F.when(ok, F.struct(F.regexp_extract(b, pattern, 1).alias("ptid"),
                               F.regexp_extract(b, pattern, 2).alias("date"),
                               F.regexp_extract(b, pattern, 3).alias("tag"),
                               b.alias("name")))


def safe_date(col, fmt: str = "yyyy-MM-dd") -> Column:
    """Parse, bad input -> null (never an error, also in ANSI mode)."""
    return F.try_to_timestamp(_c(col).cast("string"), F.lit(fmt)).cast("date")


def replace_tokens(arr, mapping: Mapping[str, str]) -> Column:
    """Element-wise token replacement map."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.transform(_c(arr), lambda t: F.coalesce(F.try_element_at(m, t), t))


def capitalize(col) -> Column:
    """First character upper, the rest lower, once per string
    (unlike initcap, which works per word)."""
    c = _c(col)
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1 << 30)))


def phrase(tokens, start, end) -> Column:
    """tokens[start:end] joined by one space (0-based, end exclusive)."""
    s, e = _c(start), _c(end)
    return F.array_join(F.slice(_c(tokens), s + 1, e - s), " ")


def clean_markers(col, markers: Iterable[str] = MARKERS) -> Column:
    """Remove marker strings."""
    import re
    pat = "|".join(re.escape(m) for m in markers)
    return F.regexp_replace(_c(col), pat, "")


def encode_label(col, order=LABEL_ORDER) -> Column:
    """Label -> index in ``order`` (null when absent)."""
    arr = F.array(*[F.lit(x) for x in order])
    pos = F.array_position(arr, _c(col))
    return F.when(pos > 0, (pos - 1).cast("int"))


def decode_label(col, order=LABEL_ORDER) -> Column:
    arr = F.array(*[F.lit(x) for x in order])
    return F.try_element_at(arr, (_c(col) + 1).cast("int"))


def delta_days(a, b) -> Column:
    """Positive absolute day difference."""
    return F.abs(F.datediff(_c(a), _c(b)))


def split_entity_token(token) -> Column:
    """A multi-word entity token 'a/b/c' -> replaced parts."""
    return replace_tokens(F.split(_c(token), "/"), COLUMN_CORPUS_TOKENS)


def _cumulative_ends(pieces: Column) -> Column:
    """Running sum of piece lengths as an array (left fold, row-local)."""
    return F.aggregate(pieces, F.array().cast("array<int>"), lambda acc, p: F.concat(
        acc, F.array((F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0))
                      + F.length(p)).cast("int"))))


def split_glued(toks) -> Column:
    """Tokens holding ')-' are split on it with ')' and '-' put between
    the pieces (empty pieces dropped); special-case map otherwise. Each new
    piece starts at the token start plus the lengths of the pieces before it.
    ``toks``: array<struct<token, start>> -> same type. Only glued tokens take
    the slow path; pieces per token are few, so the prefix lengths are cheap."""
    empty = F.array().cast("array<string>")
    special = {k: v for k, v in GLUED_SPECIAL.items()}

    def pieces(t):
        joined = F.flatten(F.transform(F.array(F.split(t, r"\)-")), lambda parts: F.flatten(F.transform(parts, lambda p, i: F.concat(
            F.when(p != "", F.array(p)).otherwise(empty),
            F.when(i < F.size(parts) - 1, F.array(F.lit(")"), F.lit("-"))).otherwise(empty))))))
        out = F.when(t.contains(")-"), joined)
        for k, v in special.items():
            out = out.when(t == k, F.array(*[F.lit(x) for x in v]))
        return out

    def expand(z):
        # the pieces are bound once: a lambda works out again, for each element, what it takes from outside
        split = F.flatten(F.transform(F.array(pieces(z["token"])), lambda ps: F.transform(ps, lambda p, i: F.struct(
            p.alias("token"), (z["start"] + F.length(F.array_join(F.slice(ps, 1, i), ""))).cast("int").alias("start")))))
        glued = z["token"].contains(")-") | z["token"].isin(*special)
        return F.when(glued, split).otherwise(F.array(z))

    return F.flatten(F.transform(_c(toks), expand))


WS_PIECE = r"(\s*\S+)"


def tokenize_sentence(sentence) -> Column:
    """B7 (token strings only): detach a final '.', split the rest on
    whitespace (no blank tokens), re-append '.' as the last token. Offsets of
    these tokens: ``tessera.operators.spans.tokenize(..., detach_final_dot=True)``."""
    s = _c(sentence)
    has_dot = s.endswith(".")
    body = F.when(has_dot, F.regexp_replace(s, r"\.$", "")).otherwise(s)
    base = F.filter(F.split(body, r"\s+"), lambda t: t != "")
    return F.when(has_dot & (F.size(base) > 0), F.concat(base, F.array(F.lit(".")))).otherwise(base)


def strip_span(text, start, end) -> Column:
    """Trim an entity text and move its char span by the trimmed amounts.
    Returns struct(text, start, end)."""
    t, s, e = _c(text), _c(start), _c(end)
    left = F.length(t) - F.length(F.regexp_replace(t, r"^\s+", ""))
    right = F.length(t) - F.length(F.regexp_replace(t, r"\s+$", ""))
    return F.struct(strip(t).alias("text"), (s + left).alias("start"), (e - right).alias("end"))
