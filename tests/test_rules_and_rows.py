"""Long chains of cleaning rules, and what a changed row is about."""

import time

from pyspark.sql import functions as F

from quillgraph.operators import changes as C
from quillgraph.sources import files as S


def test_forty_rules(spark):
    rows = [("a", "md", "one\nkeep 0\n\n\n\ndrop 7\ndrop 39\nend"), ("b", "txt", "drop 5\nkeep"), ("b", "md", None)]
    df = spark.createDataFrame(rows, "source_id string, ext string, content string")
    shared = [{"type": "strip_regex", "pattern": f"^drop {i}$"} for i in range(40)] + [{"type": "nonsense"}]
    own = {"a": [{"type": "normalize_whitespace"}, {"type": "replace_regex", "pattern": "keep", "replacement": "kept", "apply_to": [".md"]}], "b": [{"type": "strip_last_lines", "count": 1, "apply_to": ["txt"]}]}
    start = time.time()
    out, errors = S.processed(df, shared, own)
    got = {(r.source_id, r.ext): (r.content, r.rules_applied) for r in out.collect()}
    assert time.time() - start < 40 and len(errors) == 1
    assert got == {("a", "md"): ("one\nkept 0\n\nend", 42), ("b", "txt"): ("", 41), ("b", "md"): ("", 40)}


def test_row_changes(spark):
    rows = {
        "[ADDED: 0x0003 | Level | uint8 | M]": "entity_added",
        "[added: x] and [REMOVED: y]": "entity_added",
        "[REMOVED: 0x0003 | Level]": "entity_removed",
        "0x0003 | Level | [ADDED: x]": "row_changed",
        "": "row_changed",
    }
    got = spark.createDataFrame([(k,) for k in rows], "t string").select("t", C.row_change(F.col("t")).alias("k")).collect()
    assert {r.t: r.k for r in got} == rows
