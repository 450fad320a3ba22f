import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, extra=None):
    """documents rows (doc_id from 0) with a column of a clashing name added."""
    rows = [(i, t, "en", "src0", len(t or ""), "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC_SCHEMA + ", n string")
