"""Keyed state over frame streams: masklet confirmation, hotstart removal and HTML detection.

Each operator takes a streaming (or batch) DataFrame and keeps one small state a key in
Spark's state store.  Rows of a key that arrive in one batch are taken in frame order;
frames that come later than a newer one already seen are dropped, as a tracker that has
moved on cannot go back.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from lumenfold.functions.answers import looks_like_html


def confirm_masklets(frames: DataFrame, threshold: int = 3) -> DataFrame:
    """(session, obj, frame, streak, confirmed) of frames (session, obj, frame, matched).

    A miss resets the streak; once it has reached the threshold an object stays
    confirmed.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, streak, confirmed = state.get if state.exists else (-1, 0, False)
        rows = pd.concat(list(batches)).sort_values("frame", kind="stable")
        out = []
        for frame, matched in zip(rows["frame"], rows["matched"], strict=True):
            if frame <= last:
                continue
            last, streak = int(frame), streak + 1 if matched else 0
            confirmed = confirmed or streak >= threshold
            out.append((key[0], key[1], last, streak, confirmed))
        state.update((last, streak, confirmed))
        yield pd.DataFrame(out, columns=["session", "obj", "frame", "streak", "confirmed"])

    return frames.groupBy("session", "obj").applyInPandasWithState(
        step, "session string, obj long, frame long, streak long, confirmed boolean", "last long, streak long, confirmed boolean", "append", GroupStateTimeout.NoTimeout
    )


def hotstart(frames: DataFrame, delay: int = 15, misses: int = 8, keep_alive: int = 30) -> DataFrame:
    """(session, obj, frame, keep) of frames (session, obj, frame, matched).

    Within ``delay`` frames of an object's first, ``misses`` unmatched frames remove it for
    good.  A counter that a match raises and a miss lowers, clamped to ``keep_alive``, must
    stay above zero for a later frame to be kept.
    """

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        first, last, missed, alive, removed = state.get if state.exists else (-1, -1, 0, 0, False)
        rows = pd.concat(list(batches)).sort_values("frame", kind="stable")
        out = []
        for frame, matched in zip(rows["frame"], rows["matched"], strict=True):
            if frame <= last:
                continue
            last = int(frame)
            first = last if first < 0 else first
            alive = max(-keep_alive, min(keep_alive, alive + (1 if matched else -1)))
            if not matched and last - first < delay:
                missed += 1
                removed = removed or missed >= misses
            out.append((key[0], key[1], last, not removed and (alive > 0 or last - first < delay)))
        state.update((first, last, missed, alive, removed))
        yield pd.DataFrame(out, columns=["session", "obj", "frame", "keep"])

    return frames.groupBy("session", "obj").applyInPandasWithState(
        step, "session string, obj long, frame long, keep boolean", "first long, last long, missed long, alive long, removed boolean", "append", GroupStateTimeout.NoTimeout
    )


def collect_prefix(chunks: DataFrame, most_chunks: int = 5, most_chars: int = 50) -> DataFrame:
    """(key, prefix), once a key, as soon as its first chunks are complete: chunks (key, k, text, last)."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        text, count, done = state.get if state.exists else ("", 0, False)
        rows = pd.concat(list(batches)).sort_values("k", kind="stable")
        out = []
        for piece, last in zip(rows["text"], rows["last"], strict=True):
            if done:
                break
            text, count = text + (piece or ""), count + 1
            if count >= most_chunks or len(text) >= most_chars or last:
                done = True
                out.append((key[0], text[:most_chars] if count < most_chunks else text))
        state.update((text, count, done))
        yield pd.DataFrame(out, columns=["key", "prefix"])

    return chunks.groupBy("key").applyInPandasWithState(step, "key string, prefix string", "text string, count long, done boolean", "append", GroupStateTimeout.NoTimeout)


def detect_html(chunks: DataFrame) -> DataFrame:
    """(key, prefix, html) of chunk streams."""
    return collect_prefix(chunks).withColumn("html", looks_like_html("prefix"))


def windowed_counts(events: DataFrame, at: str, key: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Event counts a window and key with a watermark, for monitoring a stream of frames."""
    return events.withWatermark(at, late).groupBy(F.window(at, width), key).agg(F.count(F.lit(1)).alias("n"))
