"""Small tables for the operator tests; operators read their input from files."""

from __future__ import annotations

import uuid
from collections import Counter

from compare import TABLES  # noqa: F401  (tests/ is on the path)
from compare import oracle_rows

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def saved(spark, folder, rows, schema, files=3):
    path = f"{folder}/{uuid.uuid4().hex}"
    spark.createDataFrame(rows, schema).repartition(files).write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def documents(spark, folder, texts, extra="", values=(), files=3):
    """Texts, or (doc_id, text) pairs, as a table of documents; `extra` columns of fixed values."""
    rows = []
    for i, item in enumerate(texts):
        doc_id, text = item if isinstance(item, tuple) else (i, item)
        rows.append((doc_id, text, "en", f"src{i % 3}", len(text or ""), *values))
    return saved(spark, folder, rows, DOCS + extra, files)


def bag(rows):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in rows)


def sql_differences(df, sql, sf_dir):
    names, wanted = oracle_rows(sql, sf_dir)
    assert sorted(names) == sorted(df.columns)
    found = bag(df.select(*names).collect())
    return list((found - bag(wanted)).items())[:3], list((bag(wanted) - found).items())[:3]
