"""Readers (A1-A14): files in the reference's formats -> DataFrames.

Multi-line JSON and whole-text files are one task per file (not
splittable); everything after the read is partitioned normally.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir, cut_lineage


def new_folder(spark: SparkSession, sf_dir: str, name: str) -> str:
    """A folder of its own below the session's shared one, for files made from the tables of ``sf_dir``: by a hash of the
    whole path and a number never used before, so no other input or session writes to what a lazy frame still reads."""
    sf = hashlib.md5(os.path.normpath(sf_dir).encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark).rstrip('/')}/sources/{sf}/{name}-{uuid.uuid4().hex}"


DOC_SCHEMA = ("tokens array<string>, entities array<struct<type:string,start:int,end:int>>, "
              "relations array<struct<type:string,head:int,tail:int>>, orig_id string")


def read_docs(spark: SparkSession, path: str) -> DataFrame:
    """A1: JSON array(s) of annotated documents (one array per file)."""
    return spark.read.schema(DOC_SCHEMA).option("multiLine", True).json(path)


def read_split_docs(spark: SparkSession, path: str, splits=("train", "dev", "test")) -> DataFrame:
    """A2: files holding {split: [docs]}; rows get their split name."""
    doc = ("struct<tokens:array<string>, entities:array<struct<type:string,start:int,end:int>>, "
           "relations:array<struct<type:string,head:int,tail:int>>, orig_id:string>")
    schema = ", ".join(f"{s} array<{doc}>" for s in splits)
    raw = spark.read.schema(schema).option("multiLine", True).json(path)
    out = None
    for s in splits:
        part = raw.select(F.explode(s).alias("d")).select("d.*").withColumn("split", F.lit(s))
        out = part if out is None else out.unionByName(part)
    return out


def read_untagged(spark: SparkSession, path: str) -> DataFrame:
    """A3: JSON lines where a record is a token list, an object with
    ``tokens`` or a plain string (split on spaces). Dispatch on the variant's
    schema."""
    v = spark.read.text(path).filter(F.trim("value") != "").select(F.parse_json("value").alias("v"))
    kind = F.schema_of_variant("v")
    toks = (F.when(kind.startswith("ARRAY"), F.variant_get("v", "$", "array<string>"))
             .when(kind.startswith("OBJECT"), F.variant_get("v", "$.tokens", "array<string>"))
             .otherwise(F.split(F.variant_get("v", "$", "string"), " ")))
    return v.select(F.when(kind.startswith("ARRAY"), "list").when(kind.startswith("OBJECT"), "object")
                    .otherwise("text").alias("kind"), toks.alias("tokens"))


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A4: JSON lines; blank lines are skipped by the reader."""
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.json(path)


def read_pipe_relations(spark: SparkSession, path: str) -> DataFrame:
    """``doc|sentence|effect|s|e|drug|s|e`` lines, no quoting; trimmed,
    offsets cast to int."""
    names = ["doc", "sentence", "effect", "e_start", "e_end", "drug", "d_start", "d_end"]
    raw = spark.read.option("sep", "|").option("quote", "\u0000").csv(path).toDF(*names)
    return raw.select("doc", "sentence", "effect", F.trim("e_start").cast("int").alias("e_start"),
                      F.trim("e_end").cast("int").alias("e_end"), "drug",
                      F.trim("d_start").cast("int").alias("d_start"), F.trim("d_end").cast("int").alias("d_end"))


def filter_by_index(df: DataFrame, index: DataFrame, id_col: str) -> DataFrame:
    """Keep rows whose id appears in a split-index file (``id:...``)."""
    ids = index.select(F.split_part("value", F.lit(":"), F.lit(1)).cast("long").alias(id_col)).distinct()
    return df.join(ids, id_col, "left_semi")


def read_labels(spark: SparkSession, path: str, required=("PTID", "EXAMDATE"),
                label_candidates=("DX", "DX_bl")) -> DataFrame:
    """All-string CSV with header; required columns, first present label
    column (error when none)."""
    df = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    lab = next((c for c in label_candidates if c in df.columns), None)
    if lab is None:
        raise ValueError(f"none of the label columns {label_candidates}")
    return df.select(*required, F.col(lab).alias("DX"))


def read_series(spark: SparkSession, path: str) -> DataFrame:
    """Headerless wide numeric CSV; last column = label."""
    df = spark.read.option("header", False).csv(path)
    cols = df.columns
    return df.select(F.array(*[F.col(c).cast("double") for c in cols[:-1]]).alias("series"),
                     F.col(cols[-1]).cast("double").cast("int").alias("label"))


def _glob_pattern(pattern: str) -> str:
    """A file glob (*, ?, [a-b], [^a], {a,b}, backslash) as a regular expression of the whole name."""
    out, depth, i = [], 0, 0
    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern):
            i += 1
            out.append(re.escape(pattern[i]))
        elif c == "[" and "]" in pattern[i + 2:]:
            stop = pattern.index("]", i + 2)
            inner = pattern[i + 1:stop]
            out.append("[" + ("^" + inner[1:] if inner[0] in "!^" else inner) + "]")
            i = stop
        elif c == "{":
            depth += 1
            out.append("(?:")
        elif c == "}" and depth:
            depth -= 1
            out.append(")")
        elif c == "," and depth:
            out.append("|")
        else:
            out.append({"*": "[^/]*", "?": "[^/]"}.get(c, re.escape(c)))
        i += 1
    return "".join(out)


def list_files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """A10: the files below ``path`` whose names match the glob ``pattern``, in any folder: (path, name, bytes, modified). Tasks list
    the folders of each level of the tree through the file system that ``path`` names; names stay in tables, none is held by the
    driver, and no file is opened. As in Spark's own listing, names that begin with a dot or an underscore are hidden. A store that
    only Spark's readers know is listed by its file index."""
    from pyarrow import fs

    from tessera.session import ship
    try:
        kind = fs.FileSystem.from_uri(path)[0].type_name
    except Exception:  # noqa: BLE001 - no such scheme here
        f = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(path)
        return f.select("path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"),
                        F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    prefix, wanted = "file:" if kind == "local" else path.partition("://")[0] + "://", _glob_pattern(pattern)

    def run(batches):
        import pandas as pd
        own, _ = fs.FileSystem.from_uri(path)
        for batch in batches:
            for folder in batch["path"]:
                found = [f for f in own.get_file_info(fs.FileSelector(folder)) if f.base_name[0] not in "._"]
                found = [f for f in found if f.type == fs.FileType.Directory or re.fullmatch(wanted, f.base_name)]
                for at in range(0, len(found), 10_000):
                    part = found[at:at + 10_000]
                    yield pd.DataFrame({"path": [f.path for f in part], "folder": [f.type == fs.FileType.Directory for f in part],
                                        "bytes": [f.size or 0 for f in part], "modified": pd.to_datetime([(f.mtime_ns or 0) // 1_000_000 for f in part], unit="ms", utc=True)})

    level = spark.createDataFrame([(fs.FileSystem.from_uri(path)[1],)], "path string")
    levels = []
    while True:
        dealt = level.repartition(spark.sparkContext.defaultParallelism)   # folders, one by one
        levels.append(cut_lineage(ship(dealt).mapInPandas(run, "path string, folder boolean, bytes long, modified timestamp"), "files"))
        level = levels[-1].filter("folder").select("path")
        if level.isEmpty():
            break
    files = functools.reduce(DataFrame.unionByName, levels).filter("NOT folder")
    return files.select(F.concat(F.lit(prefix), "path").alias("path"), F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "bytes", "modified")


#: How the line begins that names the matrix below it, in a file of several.
MATRIX_MARK = "# "


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    """Whitespace-separated matrices, compressed or not, row order kept: (file, name, row, values array<double>). A file
    holds one matrix, or several with a line ``# name`` above each; blank lines hold no row. A file is one text of
    one task (writers keep files bounded); rows are numbered in it by windows."""
    t = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), "value")
    r = t.select("file", F.posexplode(F.split("value", "\n")).alias("ln", "line"))
    r = r.filter(F.regexp_replace("line", r"\s+", "") != "")
    mark = F.col("line").startswith(MATRIX_MARK)
    so_far = Window.partitionBy("file").orderBy("ln")
    r = r.withColumn("_m", F.last(F.when(mark, F.col("ln")), ignorenulls=True).over(so_far))
    r = r.withColumn("name", F.last(F.when(mark, F.trim(F.substring("line", len(MATRIX_MARK) + 1, 1 << 30))), ignorenulls=True).over(so_far)).filter(~mark)
    r = r.withColumn("row", F.row_number().over(Window.partitionBy("file", "_m").orderBy("ln")) - 1)
    cells = F.filter(F.split(F.trim("line"), r"\s+"), lambda x: x != "")
    return r.select("file", "name", "row", F.transform(cells, lambda x: x.cast("double")).alias("values"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a file, or of a folder's files in order of their names, numbered from 1: (line_no, value). Lines are read in
    parallel splits; where a split begins is the number of lines before it, one row a split."""
    t = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_block_start").alias("_s"),
                                     F.monotonically_increasing_id().alias("_id"))
    t = cut_lineage(t, "lines", "zstd")   # ids are those of this one scan
    splits = t.groupBy("_f", "_s").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, -1))   # one row a split of a file
    splits = splits.select("_f", "_s", "_first", F.coalesce(before, F.lit(0)).alias("_before"))
    # splits are a bounded table, so that no line moves to be numbered
    return t.join(F.broadcast(splits), ["_f", "_s"]).select((F.col("_before") + F.col("_id") - F.col("_first") + 1).alias("line_no"), "value")


def read_graphs(spark: SparkSession, edges: str, indicator: str, labels: str, attributes: str, numbered: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A graph collection in its text layout. Line n of ``indicator`` is the graph (from 1) of node n; line n of ``attributes`` its
    features, by commas; line g of ``labels`` the label of graph g; a line ``i, j`` of ``edges`` joins nodes i and j. Nodes are
    numbered through all graphs in the files and within their graph here: nodes (graph_id, node, x array<double>), edges (graph_id,
    src, dst), graphs (graph_id, label). ``numbered``: nodes have their number ``n`` through all graphs and the label of their graph too, edges are
    (n, dst), with the number of the node they leave: narrow rows meet by graph, and all else by that one number."""
    of = numbered_lines(spark, indicator).select(F.col("line_no").alias("_n"), F.trim("value").cast("long").alias("graph_id"))
    rank = Window.partitionBy("graph_id").orderBy("_n")
    of = of.withColumn("node", (F.row_number().over(rank) - 1).cast("int"))
    x = numbered_lines(spark, attributes).select(F.col("line_no").alias("_n"), F.transform(F.split("value", ","), lambda v: F.trim(v).cast("double")).alias("x"))
    ends = F.split("value", ",")
    pairs = spark.read.text(edges).filter(F.trim("value") != "").select(F.trim(ends[0]).cast("long").alias("_i"), F.trim(ends[1]).cast("long").alias("_j"))
    dst = of.select(F.col("_n").alias("_j"), F.col("node").alias("dst"))
    graphs = numbered_lines(spark, labels).select(F.col("line_no").alias("graph_id"), F.trim("value").cast("int").alias("label"))
    if numbered:
        nodes = of.join(graphs, "graph_id").join(x, "_n").select(F.col("_n").alias("n"), "graph_id", "label", "node", "x")
        return nodes, pairs.filter(F.col("_i").isNotNull()).join(dst, "_j").select(F.col("_i").alias("n"), "dst"), graphs
    src = of.select(F.col("_n").alias("_i"), "graph_id", F.col("node").alias("src"))
    return (of.join(x, "_n").select("graph_id", "node", "x"),
            pairs.join(src, "_i").join(dst, "_j").select("graph_id", "src", "dst"), graphs)


def graph_counts(nodes: DataFrame, edges: DataFrame, graphs: DataFrame) -> DataFrame:
    """How many graphs, nodes and edges a collection holds, as one aggregate."""
    kinds = [d.select(F.lit(k).alias("k")) for k, d in (("g", graphs), ("n", nodes), ("e", edges))]
    return kinds[0].unionByName(kinds[1]).unionByName(kinds[2]).agg(
        *[F.count_if(F.col("k") == k).alias(c) for k, c in (("g", "n_graphs"), ("n", "n_nodes"), ("e", "n_edges"))])


#: Verbose names of the type that stands for none (fixed values).
NO_TYPE = {"entities": "No Entity", "relations": "No Relation"}


def load_types(spark: SparkSession, path: str) -> DataFrame:
    """Ordered type registry {entities:{name:{short,verbose[,symmetric]}},
    relations:{...}}: (kind, name, idx, short, verbose, symmetric); index = position + 1 in file order (json_object_keys
    keeps it); 'None' = 0 per kind."""
    raw = spark.read.text(path, wholetext=True)
    val = "map<string, struct<short:string, verbose:string, symmetric:boolean>>"
    out = None
    for kind, nothing in NO_TYPE.items():
        obj = F.get_json_object("value", f"$.{kind}")
        k = raw.select(obj.alias("o")).select(F.posexplode(F.json_object_keys("o")).alias("pos", "name"),
                                               F.from_json("o", val).alias("m"))
        own = F.col("m")[F.col("name")]
        k = k.select(F.lit(kind).alias("kind"), "name", (F.col("pos") + 1).cast("int").alias("idx"), own["short"].alias("short"),
                     own["verbose"].alias("verbose"), F.coalesce(own["symmetric"], F.lit(False)).alias("symmetric"))
        none = spark.range(1).select(F.lit(kind).alias("kind"), F.lit("None").alias("name"), F.lit(0).alias("idx"), F.lit("None").alias("short"),
                                     F.lit(nothing).alias("verbose"), F.lit(False).alias("symmetric"))
        part = none.unionByName(k)
        out = part if out is None else out.unionByName(part)
    return out


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary file, one piece a line: (piece, idx) with idx = line number from 0. It is
    read as one text: a vocabulary is of a model's size."""
    t = spark.read.text(path, wholetext=True).filter(F.col("value") != "")
    lines = t.select(F.posexplode(F.split(F.regexp_replace("value", "\n$", ""), "\n")).alias("idx", "piece"))
    return lines.select("piece", "idx")


def read_parallel(spark: SparkSession, path: str, cols=("inp_expression", "out_expression")) -> DataFrame:
    """Objects of parallel arrays -> one row per position."""
    raw = spark.read.schema(", ".join(f"{c} array<string>" for c in cols)).option("multiLine", True).json(path)
    z = raw.select(F.explode(F.arrays_zip(*cols)).alias("z"))
    return z.select(*[F.col(f"z.{c}").alias(c) for c in cols])


def read_conll(spark: SparkSession, path: str) -> DataFrame:
    """A5: blank-line-delimited column corpus. 9-column rows are tokens
    (doc index, entity type, token index, _, _, token, ...), 3-column rows are
    relations (head token index, tail token index, type). Every second blank
    line ends a document; a last document without its second blank line is
    dropped. An entity token 'a/b' becomes several tokens (B5).

    A file is one ordered text, read and cut into documents by one task line after line (writers keep files
    bounded); nothing is shuffled. Documents without tokens give no row. A relation's argument is the number of the entity
    at that token, null if there is none.
    Returns one row per document: (orig_id, tokens, entities, relations)."""
    from tessera.session import ship
    t = spark.read.text(path, wholetext=True).filter(F.col("value") != "")
    return ship(t).mapInArrow(_conll_batches, "orig_id string, tokens array<string>, entities array<struct<type:string,start:int,end:int>>, "
                                              "relations array<struct<type:string,head:int,tail:int>>")


#: Documents of a column corpus in one batch.
CONLL_BATCH = 5_000


def _conll_batches(batches):
    """Arrow batches of whole files -> batches of their documents."""
    import itertools

    import pyarrow as pa
    spans = pa.list_(pa.struct([("type", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
    links = pa.list_(pa.struct([("type", pa.string()), ("head", pa.int32()), ("tail", pa.int32())]))
    for batch in batches:
        for text in batch.column(0):
            docs = _conll_docs(text.as_py())
            while some := list(itertools.islice(docs, CONLL_BATCH)):
                ids, tokens, ents, rels = zip(*some)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(tokens, pa.list_(pa.string())), _listed(ents, spans), _listed(rels, links)],
                                                 ["orig_id", "tokens", "entities", "relations"])


def _listed(lists, kind):
    """Lists of tuples as an Arrow array of lists of structs."""
    import itertools

    import pyarrow as pa
    at = pa.array([0, *itertools.accumulate(map(len, lists))], pa.int32())
    fields = list(kind.value_type)
    columns = list(zip(*itertools.chain.from_iterable(lists))) or [()] * len(fields)
    return pa.ListArray.from_arrays(at, pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(columns, fields)], fields=fields))


def _conll_docs(text: str):
    """(orig_id, tokens, entities, relations) of each document of a file that its second blank line ends."""
    from tessera.functions.text import COLUMN_CORPUS_TOKENS
    # a final newline ends the last line, and one right before it the file's last block; they are no blank lines
    lines = re.sub("\n(?=(?:\r\n|[\n\r\u0085\u2028\u2029])?\\Z)", "", text).split("\n")
    blanks, orig, tokens, ents, rows = 0, None, [], [], []
    for line in lines:
        if line:
            c = line.split("\t")
            if len(c) == 9:
                parts = [c[5]] if c[1] == "O" else c[5].split("/")
                if not tokens:
                    orig = c[0]
                if c[1] != "O":
                    ents.append((c[1], len(tokens), len(tokens) + len(parts), int(c[2])))
                tokens.extend(COLUMN_CORPUS_TOKENS.get(p, p) for p in parts)
            elif len(c) == 3:
                rows.append((c[2], int(c[0]), int(c[1])))
            continue
        blanks += 1
        if blanks % 2:
            continue
        if tokens:
            at: dict = {}
            for k, e in enumerate(ents):
                at.setdefault(e[3], []).append(k)
            yield orig, tokens, [e[:3] for e in ents], [(t, h, g) for t, head, tail in rows for h, g in sorted(
                ((h, g) for h in at.get(head, [None]) for g in at.get(tail, [None])), key=lambda x: tuple((y is not None, y) for y in x))]
        orig, tokens, ents, rows = None, [], [], []
