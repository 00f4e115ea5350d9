"""Small tables with the awkward cases that every operator has to bear."""

from pyspark.sql import functions as F

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
# Columns that the operators use inside, or return.
CLASHING = ["score", "predicted", "fp", "component", "fingerprint", "term", "pos", "start", "length", "blob", "found", "part", "node",
            "__x", "label", "w", "mask", "size", "__id", "__th", "__text", "__doc", "__blob", "__found", "__new", "__row", "__y", "a.b"]


def docs(spark, rows, clashing=False):
    """A documents table from (doc_id, text)."""
    df = spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)
    return df.withColumns({c: F.lit(f"own {c}") for c in CLASHING}) if clashing else df


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
