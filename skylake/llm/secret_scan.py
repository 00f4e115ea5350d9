"""Secret scans with an incremental ledger of blobs.

Every version of a text is addressed by its SHA-256. A ledger table records which (blob, rule version) pairs have been
scanned, and another the findings, a row per finding. A scan reads only the blobs whose pair is new: each is sent once to be scanned,
by the row with the smallest id that holds it, however many rows and paths share it. Findings are then joined back to all rows of
their blob. The ledger is only appended to: findings first, then the pairs, so what a failed scan left is scanned again.

Rules (versioned together by RULES): the three base kinds, and `pem` for a private key from its BEGIN line to the END line of the same name,
or, where the next such line is another, to the end of its base64 lines.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skylake.llm.common import packed, settle_counted
from skylake.session import fresh_path, settle

RULES = "base-2"
KINDS = ("assign", "access", "hex", "pem")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # a run of 16 or more starts where the run of any length does
_PEM = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*PRIVATE KEY(?: BLOCK)?)-----")
# What follows a BEGIN line without an END line: header lines, an empty line, base64 lines of which the first is 16 characters or longer.
_BREAK = r"[ \t]*(?:\r?\n|\r|\\r\\n|\\n)[ \t]*+"
_BODY = re.compile(rf"(?:{_BREAK}[A-Za-z][A-Za-z-]*:[^\r\n\\]*+)*+(?:{_BREAK})++[A-Za-z0-9+/]{{16,}}+=*+(?:{_BREAK}=?[A-Za-z0-9+/]++=*+(?=[ \t]*(?:[\r\n\\\"',;]|\Z)))*+")
FOUND = "kind int, start bigint, end bigint"
LEDGER = "blob string, rules string"


def spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of every finding in code points, by start and then kind."""
    found = []
    lower = text.lower()
    if any(k in lower for k in ("passw", "secret", "token", "api_key", "apikey")):
        found += [(0, m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m.group(2)) >= 12]
    if "AKIA" in text:
        found += [(1, m.start(), m.end()) for m in _ACCESS.finditer(text) if len(m.group()) >= 18]
    found += [(2, m.start(), m.end()) for m in _HEX.finditer(text)]
    if "-----BEGIN " in text:
        found += _keys(text)
    return sorted(found, key=lambda x: (x[1], x[0], x[2]))


def _keys(text: str) -> list[tuple[int, int, int]]:
    """Private keys, BEGIN line to END line or end of body."""
    marks, found = list(_PEM.finditer(text)), []
    for m, after in zip(marks, [*marks[1:], None]):
        if m[1] == "BEGIN":
            if after and after[1] == "END" and after[2] == m[2]:
                end = after.end()
            else:
                body = _BODY.match(text, m.end(), after.start() if after else len(text))
                end = body.end() if body else m.end()
            found.append((3, m.start(), end))
    return found


class Ledger:
    """Scanned pairs and findings below a folder of the shared store; by default a new, empty one."""

    def __init__(self, spark: SparkSession, path: str | None = None):
        self.spark, self.path = spark, path or fresh_path(spark, "ledger")
        for name, schema in (("scanned", LEDGER), ("findings", f"{LEDGER}, {FOUND}")):
            spark.createDataFrame([], schema).write.mode("append").parquet(f"{self.path}/{name}")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def scanned(self) -> DataFrame:
        return self._read("scanned", LEDGER)

    def findings(self) -> DataFrame:
        return self._read("findings", f"{LEDGER}, {FOUND}")

    def add(self, findings: DataFrame, scanned: DataFrame) -> None:
        """Findings first, then what was scanned: if the second write fails, the blobs are scanned again and
        their findings, equal to the stored ones, are made one on reading."""
        findings.write.mode("append").parquet(f"{self.path}/findings")
        scanned.write.mode("append").parquet(f"{self.path}/scanned")


def blob(text_col: str):
    return F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.string(), pa.int32(), pa.int64(), pa.int64()]
    for batch in batches:
        rows = [(b.as_py(), *s) for b, t in zip(batch.column(0), batch.column(1)) for s in spans(t.as_py() or "")]
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["blob", "kind", "start", "end"])


def scan(docs: DataFrame, ledger: Ledger, id_col: str = "doc_id", text_col: str = "text", rules: str = RULES) -> dict[str, int]:
    """Bring the ledger up to date with the texts of `docs`; how many blobs were scanned."""
    own = F.struct(F.col(id_col).isNull(), F.coalesce(F.col(id_col), F.lit(0)), F.xxhash64(id_col, text_col))
    held = docs.select(blob(text_col).alias("blob"), own.alias("own"))
    known = ledger.scanned().where(F.col("rules") == rules).select("blob").distinct()
    todo, seen = settle_counted(held.groupBy("blob").agg(F.min("own").alias("own")).join(known, "blob", "left_anti").select(
        F.col("blob").alias("__blob"), F.col("own.*")).toDF("__blob", "__none", "__id", "__th"), "unseen")
    if seen["n"]:
        texts = docs.select(F.coalesce(F.col(id_col), F.lit(0)).alias("__id"), F.xxhash64(id_col, text_col).alias("__th"),
                            F.col(text_col).alias("__text"))
        unseen = texts.join(todo.select("__blob", "__id", "__th"), ["__id", "__th"]).select("__blob", "__text")
        found = unseen.mapInArrow(_scan, f"blob string, {FOUND}")
        ledger.add(found.select("blob", F.lit(rules).alias("rules"), "kind", "start", "end"),
                   todo.select(F.col("__blob").alias("blob"), F.lit(rules).alias("rules")))
    return {"scanned": seen["n"]}


def by_blob(ledger: Ledger, rules: str = RULES) -> DataFrame:
    """(blob, found): the findings of each blob that has any, as an array ordered by start and kind."""
    each = ledger.findings().where(F.col("rules") == rules).select("blob", "kind", "start", "end").distinct()
    found = each.groupBy("blob").agg(F.array_sort(F.collect_list(F.struct("start", "kind", "end"))).alias("found"))
    return settle(found, "by_blob")  # read from files, a join with the rows of a hot blob can be split


def findings(docs: DataFrame, ledger: Ledger | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of `docs` its id as `__doc` and `found`, an array of (start, kind, end); empty without findings.

    Null texts are empty blobs. Rows with equal texts share one scan; equal rows each come out.
    """
    ledger = ledger or Ledger(docs.sparkSession)
    scan(docs, ledger, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("__doc"), blob(text_col).alias("blob"))
    found = F.coalesce("found", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    return rows.join(by_blob(ledger), "blob", "left").select("__doc", found.alias("found"))


def _listed(found) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda x: F.concat_ws(
        ":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def op7_secrets(docs: DataFrame) -> DataFrame:
    rows = findings(docs)
    count = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("bigint")
    base = F.filter("found", lambda x: x["kind"] < 3)
    return rows.select(
        F.col("__doc").alias("doc_id"), count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("found")).alias("spans"))


def _redacted(text: pa.Array, starts: pa.Array, ends: pa.Array, kinds: pa.Array) -> pa.Array:
    out = []
    for row in zip(text, starts, ends, kinds):
        t, first, last, kind = (v.as_py() for v in row)
        parts, at = [], 0
        for a, b, k in zip(first, last, kind):
            if a >= at:
                parts += [t[at:a], f"[{KINDS[k]}]"]
            at = max(at, b)
        out.append("".join([*parts, t[at:]]))
    return pa.array(out, pa.string())


def redact(docs: DataFrame, text_col: str = "text", chars_col: str | None = "n_chars", ledger: Ledger | None = None) -> DataFrame:
    """`docs` with every finding replaced by its kind in brackets, and `chars_col` (if there is such a column) set to the new
    length of the changed texts. Overlapping findings are taken out as one. All rows stay; texts without findings,
    nulls included, stay as they are."""
    ledger = ledger or Ledger(docs.sparkSession)
    scan(docs, ledger, text_col=text_col)
    found = by_blob(ledger).select(F.col("blob").alias("__blob"), F.col("found").alias("__found"))
    rows = docs.select(packed(docs), blob(text_col).alias("__b")).join(found, F.col("__b") == F.col("__blob"), "left")
    own = lambda c: F.col("__row").getField(c)
    empty = F.array().cast("array<bigint>")
    part = lambda name: F.coalesce(F.col(f"__found.{name}"), empty)
    text = F.when(F.col("__found").isNotNull(), F.arrow_udf(_redacted, "string")(F.coalesce(own(text_col), F.lit("")), part("start"), part("end"), part("kind")))
    rows = rows.withColumn("__new", text)
    new = F.coalesce("__new", own(text_col))
    columns = [new.alias(c) if c == text_col else
               F.when(F.col("__new").isNotNull(), F.length("__new")).otherwise(own(c)).cast(docs.schema[c].dataType).alias(c)
               if c == chars_col else own(c).alias(c) for c in docs.columns]
    return rows.select(*columns)
