from __future__ import annotations

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _key string, fp string, node string"


def docs_frame(spark, rows, **columns):
    """Documents from ``(doc_id, text)`` pairs, with columns whose names clash with inner ones."""
    full = []
    for k, (doc_id, text) in enumerate(rows):
        own = {name: values[k] for name, values in columns.items()}
        n_chars = None if text is None else len(text)
        full.append((doc_id, text, own.get("lang"), own.get("source"), n_chars, "x", "y", None))
    return spark.createDataFrame(full, SCHEMA)
