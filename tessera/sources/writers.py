"""Writers (A15-A18). Output goes to shared storage; every writer is a
distributed write (no driver-side file assembly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_docs(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Documents / predictions as JSON lines (one document per line)."""
    df.write.mode(mode).json(path)


#: Bytes of text in a file that one task reads as a whole.
FILE_BYTES = 16 << 20


def files_of(df: DataFrame, text: Column, file_bytes: int | None = None) -> int:
    """How many files hold the ``text`` of all rows: their number follows the data, their size does not."""
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0   # one number
    return max(1, -(-total // (file_bytes or FILE_BYTES)))


def file_of(key: Column, files: int) -> Column:
    """The file of a row, by a hash of its key."""
    return F.pmod(F.xxhash64(key), F.lit(files))


def write_doc_arrays(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A15 (array layout): one JSON array of documents per (compressed) file, the layout
    the JSON-array reader (A1) expects. Files hold about FILE_BYTES of text, as many
    as the documents need."""
    write_bundles(df.select(F.to_json(F.struct(*df.columns)).alias("value")), path, mode=mode)


def write_bundles(df: DataFrame, path: str, kinds: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """The JSON texts ``value`` of ``df`` as files of one JSON array each, or of one object with an array for each of ``kinds`` (the
    texts whose column ``kind`` it is). Each task puts its rows together to files of about FILE_BYTES of text where they are, and they
    are written compressed: nothing is shuffled."""
    from tessera.session import ship
    size = FILE_BYTES

    def run(batches):
        return _bundles(batches, kinds, size)

    files = ship(df.select(*(["kind"] if kinds else []), "value")).mapInArrow(run, "value string")
    files.write.mode(mode).option("compression", "gzip").option("maxRecordsPerFile", 1).text(path)


def _bundles(batches, kinds: tuple[str, ...], size: int):
    """Arrow batches of (kind,) value -> the text of each file."""
    import json

    import pyarrow as pa

    def text():
        listed = {k: "[" + ",".join(v) + "]" for k, v in held.items()}
        body = "{" + ",".join(f"{json.dumps(k)}:{v}" for k, v in listed.items()) + "}" if kinds else listed[None]
        return pa.RecordBatch.from_arrays([pa.array([body], pa.string())], ["value"])

    empty = lambda: ({k: [] for k in kinds or (None,)}, 0)
    held, filled = empty()
    for batch in batches:
        which = batch.column(0).to_pylist() if kinds else [None] * batch.num_rows
        for kind, value in zip(which, batch.column(batch.num_columns - 1)):
            value = value.as_py()
            held[kind].append(value)
            filled += len(value)
            if filled >= size:
                yield text()
                held, filled = empty()
    if filled:
        yield text()


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = True, mode: str = "overwrite") -> None:
    """Manifest TSV / predictions CSV."""
    df.write.mode(mode).option("sep", sep).option("header", header).csv(path)


def append_metrics(df: DataFrame, path: str, label_col: str = "label") -> None:
    """Append metric rows to a per-label log (one folder per label)."""
    df.write.mode("append").partitionBy(label_col).parquet(path)


def pivot_history(df: DataFrame, step: str, tag: str, value: str, tags: list[str]) -> DataFrame:
    """One row per step, one column per tag (tags listed: no extra job
    to discover them)."""
    return df.groupBy(step).pivot(tag, tags).agg(F.first(value))


def write_named_files(df: DataFrame, path: str, name: str = "name", value: str = "value") -> int:
    """One file a row of ``df`` below ``path``: ``name`` is its place there (folders are made), ``value`` its text; a name that ends
    in .gz is compressed. Tasks write their rows through the file system that ``path`` names; a task that is run again writes the same
    files again. Returns how many were written."""
    from tessera.session import ship

    def run(batches):
        import gzip

        import pandas as pd
        from pyarrow import fs
        own, top = fs.FileSystem.from_uri(path)
        made = set()
        for batch in batches:
            for n, v in zip(batch["_n"], batch["_v"]):
                place = f"{top}/{n}"
                folder = place.rsplit("/", 1)[0]
                if folder not in made:
                    own.create_dir(folder, recursive=True)
                    made.add(folder)
                text = (v or "").encode()
                with own.open_output_stream(place, compression=None) as out:
                    out.write(gzip.compress(text, mtime=0) if n.endswith(".gz") else text)
            yield pd.DataFrame({"n": [len(batch)]})

    rows = ship(df).select(F.col(name).cast("string").alias("_n"), F.col(value).cast("string").alias("_v"))
    return rows.mapInPandas(run, "n long").agg(F.sum("n")).first()[0] or 0   # one number
