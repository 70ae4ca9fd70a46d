"""K2 / K3 edge format: keyed JSON documents written as sorted text lines.

The reference writes each catalog or manifest as one JSON object
``{header..., "videos": {id: record, ...}}``. Building that object in one row
would put a whole subject in one task. Instead every entry becomes one text
line; a global sort on (document, section, kind, key) spreads a big document
over many tasks, and ``partitionBy(document)`` gives one folder per document
whose part files, concatenated in name order, are exactly the JSON document.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelcat.session import sized, stage_table

JSON_OPTIONS = {"ignoreNullFields": "false"}


def json_string(c: Column) -> Column:
    """A JSON string literal for a text column (``null`` for null)."""
    return F.when(c.isNull(), F.lit("null")).otherwise(F.regexp_extract(F.to_json(F.array(c)), r"^\[(.*)\]$", 1))


def document_lines(doc_col: str, sections: Sequence[tuple[str, DataFrame]], names: DataFrame | None = None,
                   header_json: str | None = None) -> DataFrame:
    """Lines of keyed JSON documents: (doc, _s, _k, _key, line), to be sorted and written.

    Each section is (name, DataFrame(doc, key, value_json)); keys are unique per
    document and section, a null key is written as ``"null"``. ``header_json`` is text
    placed after ``{``. ``names`` (doc) lists documents to write even without entries.

    The first key of each section comes from one aggregate with partial minima over documents and
    keys alone and is broadcast if its rows are few, so that a document with most of the
    entries isn't gathered for it, and no entry's text is written before the sort.
    """
    entries = None
    for i, (_, e) in enumerate(sections, start=1):
        e = e.select(F.col(doc_col), F.lit(i).alias("_s"), F.coalesce("key", F.lit("null")).alias("_key"), F.col("value_json"))
        entries = e if entries is None else entries.unionByName(e)
    firsts = stage_table(entries.groupBy(doc_col, "_s").agg(F.min("_key").alias("_first")), "document-firsts")
    marked = entries.join(sized(firsts), [doc_col, "_s"])
    body = marked.select(
        doc_col, "_s", F.lit(1).alias("_k"), "_key",
        F.concat(F.when(F.col("_key") == F.col("_first"), F.lit("    ")).otherwise(F.lit("  , ")),
                 json_string(F.col("_key")), F.lit(": "), F.col("value_json")).alias("line"))
    docs = firsts.select(doc_col)
    if names is not None:
        docs = docs.unionByName(names.select(doc_col))
    n = len(sections)
    frame = [(0, 0, "{" if header_json is None else "{\n  " + header_json)]
    for i, (name, _) in enumerate(sections, start=1):
        frame += [(i, 0, f'  "{name}": {{'), (i, 2, "  }" + ("," if i < n else ""))]
    frame.append((n + 1, 0, "}"))
    lines = F.explode(F.array(*[F.struct(F.lit(s).alias("_s"), F.lit(k).alias("_k"), F.lit(line).alias("line")) for s, k, line in frame]))
    framed = docs.distinct().select(doc_col, lines.alias("f")).select(doc_col, "f._s", "f._k", F.lit("").alias("_key"), "f.line")
    return body.unionByName(framed)


def write_documents(lines: DataFrame, doc_col: str, path: str, mode: str = "errorifexists") -> None:
    """Sort globally (range partitions keep a big document on many tasks) and write."""
    lines.orderBy(doc_col, "_s", "_k", "_key").select(doc_col, "line").write.mode(mode).partitionBy(doc_col).text(path)
