"""DuckDB twins of the derived inputs in ``fixtures.py`` (oracle side).

``with_ctes(body, *names)`` prefixes a query with the named CTEs and all of
their dependencies, in dependency order.
"""

from __future__ import annotations

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, deps: tuple[str, ...], sql: str) -> None:
    _CTES[name] = (deps, sql)


_cte("lines", (), """
SELECT doc_id, unnest(generate_series(0, len(parts) - 1)) AS sent_no, unnest(parts) AS line
FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents)""")

_cte("sents", ("lines",), r"""
SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS sent_no, ts AS tokens FROM (
  SELECT doc_id, sent_no AS line_no,
         list_filter(regexp_split_to_array(line, '\s+'), lambda x: x <> '') AS ts
  FROM lines) WHERE len(ts) > 0""")

_cte("toks", ("sents",), """
SELECT doc_id, sent_no, tok_idx, token, lead(token) OVER w AS nxt,
       CAST(sum(length(token) + 1) OVER w - length(token) - 1 AS INTEGER) AS char_start,
       CAST(sum(length(token) + 1) OVER w - 1 AS INTEGER) AS char_end
FROM (SELECT doc_id, sent_no, CAST(unnest(generate_series(0, len(tokens) - 1)) AS INTEGER) AS tok_idx,
             unnest(tokens) AS token FROM sents)
WINDOW w AS (PARTITION BY doc_id, sent_no ORDER BY tok_idx)""")

_TYPE_BY_LEN = ("CASE length(token) % 4 WHEN 0 THEN 'disease' WHEN 1 THEN 'drug' "
                "WHEN 2 THEN 'gene' ELSE 'method' END")

# phrase, cs, ce: the tokens of a mention and where they begin and end in the text; mkey: one number
# for (doc_id, sent_no, ent_idx), so that joins on a relation's two mentions cannot meet on the sentence alone
_cte("gold_m", ("toks",), f"""
SELECT doc_id, sent_no, tok_idx AS "start", tok_idx + 1 AS "end", {_TYPE_BY_LEN} AS type, token AS phrase,
       char_start AS cs, char_end AS ce
FROM toks WHERE length(token) >= 8
UNION ALL
SELECT doc_id, sent_no, tok_idx, tok_idx + 2, 'other', token || ' ' || nxt, char_start,
       CAST(char_end + 1 + length(nxt) AS INTEGER) FROM toks
WHERE length(token) >= 9 AND length(nxt) >= 9""")

_cte("pred_m", ("toks",), f"""
SELECT doc_id, sent_no, tok_idx AS "start", tok_idx + 1 AS "end",
       CASE WHEN {_TYPE_BY_LEN} = 'disease' AND tok_idx % 5 = 0 THEN 'gene'
            ELSE {_TYPE_BY_LEN} END AS type, token AS phrase, char_start AS cs, char_end AS ce
FROM toks WHERE length(token) >= 7 AND tok_idx % 7 <> 0""")

_NUMBERED = """
SELECT *, (CAST(doc_id AS HUGEINT) * 4294967296 + sent_no) * 4294967296 + ent_idx AS mkey FROM (
  SELECT doc_id, sent_no, CAST(row_number() OVER (PARTITION BY doc_id, sent_no
         ORDER BY "start", "end", type) - 1 AS INTEGER) AS ent_idx, type, "start", "end", phrase, cs, ce FROM {m})"""
_cte("gold", ("gold_m",), _NUMBERED.format(m="gold_m"))
_cte("pred", ("pred_m",), _NUMBERED.format(m="pred_m"))

_REL = """
SELECT *, (CAST(doc_id AS HUGEINT) * 4294967296 + sent_no) * 4294967296 + head AS hkey,
       (CAST(doc_id AS HUGEINT) * 4294967296 + sent_no) * 4294967296 + tail AS tkey FROM (
SELECT a.doc_id, a.sent_no, a.ent_idx AS rel_idx,
  CASE (b."start" - a."start") % 3 WHEN 0 THEN 'associated_with'
       WHEN 1 THEN 'treatment_for' ELSE 'hyponym_of' END AS type,
  CASE WHEN (a.ent_idx + 1) % 3 = 0 THEN b.ent_idx ELSE a.ent_idx END AS head,
  CASE WHEN (a.ent_idx + 1) % 3 = 0 THEN a.ent_idx ELSE b.ent_idx END AS tail
FROM {m} a JOIN {m} b ON b.mkey = a.mkey + 1 AND b.ent_idx > 0)"""

_cte("gold_rel", ("gold",), _REL.format(m="gold"))
_cte("pred_rel", ("pred",), _REL.format(m="pred"))

# relations with their argument spans resolved
_RELX = """
SELECT r.doc_id, r.sent_no, r.rel_idx, r.type, r.head, r.tail,
       h."start" AS hs, h."end" AS he, h.type AS ht, h.phrase AS hp, h.ce AS hce,
       t."start" AS ts_, t."end" AS te, t.type AS tt, t.phrase AS tp, t.cs AS tcs
FROM {r} r JOIN {m} h ON r.hkey = h.mkey JOIN {m} t ON r.tkey = t.mkey"""
_cte("gold_relx", ("gold", "gold_rel"), _RELX.format(r="gold_rel", m="gold"))
_cte("pred_relx", ("pred", "pred_rel"), _RELX.format(r="pred_rel", m="pred"))

# predictions of ``retyped_docs``
_cte("retyped", ("gold",), """
SELECT * FROM gold QUALIFY NOT (doc_id % 4 = 0 AND count(*) OVER (PARTITION BY doc_id, sent_no) = 1)""")
_cte("retyped_rel", ("gold_rel",), """
SELECT * REPLACE (CASE WHEN sent_no % 3 <> 0 THEN type WHEN type = 'associated_with' THEN 'treatment_for'
  WHEN type = 'treatment_for' THEN 'hyponym_of' ELSE 'associated_with' END AS type) FROM gold_rel""")

_cte("asof_left", (), "SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'")
_cte("asof_right", (), "SELECT event_id, user_id, ts FROM events WHERE event_type = 'error'")

_SCAN = """
SELECT event_id, lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') || '_S_' ||
       lpad(CAST(user_id AS VARCHAR), 4, '0') || '__' || strftime(CAST(ts AS DATE), '%Y-%m-%d')
       || '__S' || CAST(event_id % 50 AS VARCHAR) || '.5T.csv' AS path
FROM events WHERE event_type = '{t}'"""
_cte("scan_left", (), _SCAN.format(t="view"))
_cte("scan_right", (), _SCAN.format(t="click"))


def with_ctes(body: str, *names: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in _CTES[n][0]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    if not order:
        return body
    # each derived table is made once, whatever the number of its readers and the order of joins
    parts = ",\n".join(f"{n} AS MATERIALIZED ({_CTES[n][1]}\n)" for n in order)
    return f"WITH {parts}\n{body}"


_cte("emb_long", (), """
SELECT vec_id, label, unnest(generate_series(1, len(embedding))) AS d,
       CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings""")
_cte("class_dist", ("emb_long",), """
SELECT e.vec_id, e.label AS y_true, m.c, sum((e.x - m.mu) * (e.x - m.mu)) AS dist
FROM emb_long e JOIN (SELECT label AS c, d, avg(x) AS mu FROM emb_long WHERE vec_id % 2 = 1 GROUP BY ALL) m
ON e.d = m.d WHERE e.vec_id % 2 = 0 GROUP BY ALL""")
_cte("class_preds", ("class_dist",), """
SELECT p.vec_id, p.y_true, p.y_pred, l.logits FROM
 (SELECT vec_id, y_true, c AS y_pred FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY dist, c) AS rn
  FROM class_dist) WHERE rn = 1) p
 JOIN (SELECT vec_id, list(-dist ORDER BY c) AS logits FROM class_dist GROUP BY vec_id) l USING (vec_id)""")
_cte("binary_scores", (), """
SELECT l.doc_id, l.quality AS y_true, CAST(d.n_chars AS DOUBLE) AS score
FROM labels l JOIN documents d USING (doc_id)""")


_cte("gnodes", (), """
SELECT l_orderkey AS graph_id, CAST(row_number() OVER (PARTITION BY l_orderkey
         ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS INTEGER) AS node,
       [l_quantity, l_extendedprice, l_discount, l_tax] AS x, l_returnflag AS rf,
       count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem""")
_cte("gedges", ("gnodes",), """
SELECT graph_id, node AS src, node + 1 AS dst FROM gnodes WHERE node + 1 < n
UNION ALL SELECT graph_id, node + 1, node FROM gnodes WHERE node + 1 < n""")
_cte("ggraphs", ("gnodes",), """
SELECT graph_id, CASE rf WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END AS label FROM gnodes WHERE node = 0""")
