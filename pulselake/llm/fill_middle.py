"""Fill-in-the-middle transformation with cuts at line ends, found in a Roaring-style set.

The places where a text may be cut (its start, and the end of each line) form a set of code point
offsets. It is kept as a Roaring set: offsets are grouped by their upper 16 bits, and the lower 16
bits of a group lie in the smallest of three containers: a sorted array, a bitmap with running
popcounts, or runs with running lengths. Running cardinalities over the containers answer
"which offset is the k-th?": a binary search finds the container, a local select the offset in
it. Two such questions give the two cuts of a document.

The set is built from the text one container's stretch at a time, so a very long text needs no
second copy of itself; its containers take two bytes a line at most.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import bounded_batches

# The contract's seed, shares in percent and sentinels.
SEED, FIM_PERCENT, SPM_PERCENT = 7, 100, 50
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"

#: Offsets of one container; values of an array container, above which a bitmap is smaller.
SPAN, ARRAY_MOST = 1 << 16, 4096
WORDS = SPAN // 64


class ArrayContainer:
    """Sorted lower halves."""

    def __init__(self, lows: np.ndarray):
        self.lows = lows.astype(np.uint16)

    def select(self, k: int) -> int:
        return int(self.lows[k])


class BitmapContainer:
    """One bit for every possible lower half, and the bits before each word."""

    def __init__(self, lows: np.ndarray):
        bits = np.zeros(SPAN, np.uint8)
        bits[lows] = 1
        self.words = np.packbits(bits, bitorder="little").view("<u8")
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)))

    def select(self, k: int) -> int:
        word = int(np.searchsorted(self.before, k, "right")) - 1
        left = int(self.words[word])
        for _ in range(k - int(self.before[word])):
            left &= left - 1
        return 64 * word + (left & -left).bit_length() - 1


class RunContainer:
    """First values of runs, and the values before each run."""

    def __init__(self, starts: np.ndarray, lengths: np.ndarray):
        self.starts = starts.astype(np.uint16)
        self.before = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))

    def select(self, k: int) -> int:
        run = int(np.searchsorted(self.before, k, "right")) - 1
        return int(self.starts[run]) + k - int(self.before[run])


def container(lows: np.ndarray) -> ArrayContainer | BitmapContainer | RunContainer:
    """The smallest container for sorted lower halves."""
    first = np.flatnonzero(np.diff(lows, prepend=-2) != 1)
    if 4 * len(first) < min(2 * len(lows), SPAN // 8):
        return RunContainer(lows[first], np.diff(first, append=len(lows)))
    return ArrayContainer(lows) if len(lows) <= ARRAY_MOST else BitmapContainer(lows)


class Boundaries:
    """The places where a text may be cut; the k-th is the end of its k-th line."""

    def __init__(self, text: str):
        self.highs: list[int] = []
        self.containers: list = []
        self.before = [0]
        size = len(text)
        for high in range(size // SPAN + 1):
            start = high * SPAN
            # An offset is a cut if the code point before it ends a line.
            piece = text[max(start - 1, 0) : start + SPAN - 1]
            lows = np.flatnonzero(np.frombuffer(piece.encode("utf-32-le"), np.uint32) == 10) + (start == 0)
            own = [[0]] if start == 0 else []
            own.append(lows)
            if size and size < start + SPAN and text[-1] != "\n":
                own.append([size - start])
            lows = np.concatenate(own).astype(np.int64)
            if len(lows):
                self.highs.append(high)
                self.containers.append(container(lows))
                self.before.append(self.before[-1] + len(lows))

    def __len__(self) -> int:
        return self.before[-1]

    def select(self, k: int) -> int:
        at = bisect_right(self.before, k) - 1
        return self.highs[at] * SPAN + self.containers[at].select(k - self.before[at])


def _draws(seed: int, doc_id: object) -> list[int]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]


def cut(text: str, draws: list[int], fim_percent: int, spm_percent: int) -> tuple[int, str, int | None, int | None, str]:
    """n lines, form, code points of prefix and middle, output."""
    places = Boundaries(text)
    n = len(places) - 1
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or draws[2] % 100 >= fim_percent:
        return n, "plain", None, None, text
    low, high = sorted(places.select(d % (n + 1)) for d in draws[:2])
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if draws[3] % 100 < spm_percent:
        return n, "spm", low, high - low, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", low, high - low, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_middle(
    docs: DataFrame, seed: int = SEED, fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT
) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output.

    A null text counts as empty; empty texts, and texts that hold a sentinel, stay as they are
    (``plain``). A null doc_id draws as if it were empty. Repeated rows stay rows and get equal
    results, an empty table gives none, other columns are ignored. Very long texts are
    transformed whole, one Arrow batch each.
    """
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            rows = [
                cut(text or "", _draws(seed, ident), fim_percent, spm_percent)
                for ident, text in zip(ids, batch.column(1).to_pylist())
            ]
            n, form, prefix, middle, output = map(list, zip(*rows)) if rows else ([],) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(n, pa.int64()),
                    pa.array(form, pa.string()),
                    pa.array(prefix, pa.int64()),
                    pa.array(middle, pa.int64()),
                    pa.array(output, pa.string()),
                ],
                ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made from. Transformed texts hold no sentinel of their own."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    part = lambda i: F.try_element_at(parts, F.lit(i))
    return (
        F.when(form == "psm", F.concat(part(2), part(4), part(3)))
        .when(form == "spm", F.concat(part(3), part(4), part(2)))
        .otherwise(output)
    )


def fill_middle_digests(docs: DataFrame) -> DataFrame:
    """``fill_middle`` with digests in place of texts, the second of the text rebuilt from the output."""
    made = fill_middle(docs)
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )
