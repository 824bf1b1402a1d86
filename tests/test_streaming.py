"""Streaming operators agree with folds over the whole input, whatever the micro-batches."""

from __future__ import annotations

import random

from lumenfold.streaming import sessions


def run_stream(spark, rows, schema, operator, tmp_path, batches):
    source = tmp_path / "in"
    per = -(-len(rows) // batches)
    for k in range(batches):
        spark.createDataFrame(rows[k * per : (k + 1) * per], schema).coalesce(1).write.mode("append").json(str(source))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").json(str(source))
    query = operator(stream).writeStream.format("memory").queryName(tmp_path.name.replace("-", "_")).outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    return spark.sql(f"SELECT * FROM {tmp_path.name.replace('-', '_')}").collect()


def test_confirmation_and_hotstart(spark, tmp_path):
    rng = random.Random(3)
    rows = [("s", o, f, rng.random() < 0.6) for f in range(40) for o in range(3)]
    schema = "session string, obj long, frame long, matched boolean"
    want, kept = [], []
    for o in range(3):
        streak, confirmed, missed, alive, removed = 0, False, 0, 0, False
        for f in range(40):
            m = next(r[3] for r in rows if r[1] == o and r[2] == f)
            streak = streak + 1 if m else 0
            confirmed |= streak >= 3
            want.append((o, f, streak, confirmed))
            alive = max(-30, min(30, alive + (1 if m else -1)))
            missed += not m and f < 15
            removed |= missed >= 8
            kept.append((o, f, not removed and (alive > 0 or f < 15)))
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    found = run_stream(spark, rows, schema, sessions.confirm_masklets, tmp_path / "a", 3)
    assert sorted((r.obj, r.frame, r.streak, r.confirmed) for r in found) == sorted(want)
    found = run_stream(spark, rows, schema, sessions.hotstart, tmp_path / "b", 2)
    assert sorted((r.obj, r.frame, r.keep) for r in found) == sorted(kept)


def test_html_prefix_is_emitted_once(spark, tmp_path):
    page = "<!DOCTYPE html><html><body>hello</body></html>"
    rows = [("p", k, page[k * 9 : k * 9 + 9], k == 5) for k in range(6)] + [("t", 0, "plain", False), ("t", 1, " text", True)]
    (tmp_path / "c").mkdir()
    found = run_stream(spark, rows, "key string, k long, text string, last boolean", sessions.detect_html, tmp_path / "c", 3)
    assert sorted((r.key, r.prefix, r.html) for r in found) == [("p", page[:45], True), ("t", "plain text", False)]
