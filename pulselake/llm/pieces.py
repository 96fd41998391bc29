"""SentencePiece encoding and decoding: Viterbi over an Aho-Corasick automaton of the pieces.

The pieces and scores are those of a public model file. At every character the automaton's
state gives, by its output links, all pieces that end there, and each relaxes the best score of
the position; one pass finds the segmentation with the highest sum of scores. Of equal sums the
one whose last piece is longest wins. Characters in no piece become their UTF-8 bytes.

No piece passes from a word to the space before the next, so words are segmented one by one,
and a worker remembers a bounded number of them.
"""

from __future__ import annotations

import re
from array import array
from collections import deque
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulselake.llm.common import bounded_batches

MODEL = "/opt/tokenizers/piece_bpe_32k.model"

SPACE = "▁"
#: Added to the lowest score for a character in no piece.
UNKNOWN = -10.0
#: Words a worker remembers, and the longest word it does. Result-neutral.
MEMO = 200_000
MEMO_CHARS = 64
#: Characters of a text from which on its words aren't listed all at once. Result-neutral.
PIECE = 1 << 20
WORD = re.compile(r" *[^ ]+| +")


@dataclass
class Vocabulary:
    pieces: list[str]
    scores: list[float]
    plain: list[bool]  # False for control pieces and bytes, which no text matches
    byte_ids: list[int]


def load(path: str = MODEL) -> Vocabulary:
    """Pieces of a model file that the driver can read. Workers get them with the query."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in ids]
    return Vocabulary(pieces, [model.get_score(i) for i in ids], plain, byte_ids)


class Automaton:
    """Aho-Corasick automaton whose states know the pieces that end there, longest first."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.v = vocabulary
        self.next: list[dict[str, int]] = [{}]
        self.out: list[tuple] = [()]
        own: dict[int, tuple] = {}
        lowest = 0.0
        for ident, (piece, score, plain) in enumerate(zip(vocabulary.pieces, vocabulary.scores, vocabulary.plain)):
            if not plain or not piece:
                continue
            lowest = min(lowest, score)
            state = 0
            for ch in piece:
                step = self.next[state].get(ch)
                if step is None:
                    step = len(self.next)
                    self.next.append({})
                    self.out.append(())
                    self.next[state][ch] = step
                state = step
            own[state] = (len(piece), ident, score)
        self.unknown = lowest + UNKNOWN
        self.fail = [0] * len(self.next)
        todo = deque(self.next[0].values())
        for state in todo:
            self.out[state] = (own[state],) if state in own else ()
        while todo:
            state = todo.popleft()
            for ch, step in self.next[state].items():
                back = self.fail[state]
                while back and ch not in self.next[back]:
                    back = self.fail[back]
                self.fail[step] = self.next[back].get(ch, 0)
                # Output link: what ends at the longest proper suffix ends here too.
                self.out[step] = ((own[step],) if step in own else ()) + self.out[self.fail[step]]
                todo.append(step)
        # Pieces that pass a word's end would make it wrong to segment words one by one.
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p, plain in zip(vocabulary.pieces, vocabulary.plain) if plain):
            raise ValueError("a piece holds the end of a word")

    def segment(self, word: str) -> tuple[int, ...]:
        """Ids of the best segmentation. ``SPACE`` stands for the space; see ``encode``."""
        n = len(word)
        # Score so far, length and id of the last piece. Lists are faster, arrays take 16 bytes a
        # character, so that even a huge text without spaces fits.
        short = n <= MEMO_CHARS
        best = ([float("-inf")] if short else array("d", [float("-inf")])) * (n + 1)
        taken = ([0] if short else array("i", [0])) * (n + 1)
        came = ([-1] if short else array("i", [-1])) * (n + 1)
        best[0] = 0.0
        state = 0
        nexts, fail, outs, unknown = self.next, self.fail, self.out, self.unknown
        for end in range(1, n + 1):
            ch = word[end - 1]
            step = nexts[state].get(ch)
            while step is None and state:
                state = fail[state]
                step = nexts[state].get(ch)
            state = step or 0
            top, size, link, single = best[end], 0, -1, False
            for length, ident, score in outs[state]:
                total = best[end - length] + score
                if total > top:
                    top, size, link = total, length, ident
                single = length == 1
            if not single and best[end - 1] + unknown > top:
                top, size, link = best[end - 1] + unknown, 1, -1
            best[end], taken[end], came[end] = top, size, link
        out: list[int] = []
        end = n
        while end:
            start, ident = end - taken[end], came[end]
            if ident >= 0:
                out.append(ident)
            else:
                out += [self.v.byte_ids[b] for b in reversed(word[start:end].encode("utf-8", "surrogatepass"))]
            end = start
        out.reverse()
        return tuple(out)


class Coder:
    """Encodes and decodes texts; remembers a bounded number of words."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.automaton = Automaton(vocabulary)
        self.memo: dict[str, tuple[int, ...]] = {}
        self.surface = [
            p.replace(SPACE, " ").encode() if plain else b"" for p, plain in zip(vocabulary.pieces, vocabulary.plain)
        ]
        for value, ident in enumerate(vocabulary.byte_ids):
            self.surface[ident] = bytes([value])
        # The space's own sign in a text is spelled in bytes, so that decoding gives it back.
        self.literal = tuple(vocabulary.byte_ids[b] for b in SPACE.encode())

    def encode(self, text: str | None) -> list[int]:
        """Ids of a text; a space is put before its first word. Null and empty texts have none."""
        if not text:
            return []
        memo, out = self.memo, []
        text = " " + text
        # Of very long texts one word at a time.
        for word in WORD.findall(text) if len(text) < PIECE else (m[0] for m in WORD.finditer(text)):
            ids = memo.get(word)
            if ids is None:
                ids = self._word(word)
                if len(word) <= MEMO_CHARS:
                    if len(memo) >= MEMO:
                        memo.clear()
                    memo[word] = ids
            out += ids
        return out

    def _word(self, word: str) -> tuple[int, ...]:
        if SPACE not in word:
            return self.automaton.segment(word.replace(" ", SPACE))
        parts = [self.automaton.segment(p.replace(" ", SPACE)) for p in word.split(SPACE)]
        return tuple(chain(parts[0], *(self.literal + p for p in parts[1:])))

    def decode(self, ids: list[int]) -> str:
        surface = self.surface
        return b"".join([surface[i] for i in ids])[1:].decode("utf-8", "replace")


def _lists(rows: list[list[int]]) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, rows)])
    flat = np.fromiter(chain.from_iterable(rows), np.int32, int(ends[-1]))
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))


def encode(docs: DataFrame, carry: list[str], model: str = MODEL) -> DataFrame:
    """The columns ``carry``, then ids (array of int) and round_trip, whether decoding gives the text back.

    A null text has no ids and round_trip null; an empty one has no ids.
    """
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(load(model))  # one vocabulary
    at = docs.columns.index("text")
    places = [docs.columns.index(c) for c in carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            texts = batch.column(at).to_pylist()
            rows = [coder.encode(t) for t in texts]
            same = [None if t is None else coder.decode(r) == t for t, r in zip(texts, rows)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in places), _lists(rows), pa.array(same, pa.bool_())],
                [*carry, "ids", "round_trip"],
            )

    kinds = [f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in carry]
    return docs.mapInArrow(run, ", ".join([*kinds, "ids array<int>, round_trip boolean"]))


def decode(coded: DataFrame, carry: list[str], model: str = MODEL) -> DataFrame:
    """The columns ``carry``, then text, from ``ids``. Null ids give a null text."""
    bounded_batches(coded.sparkSession)
    shared = coded.sparkSession.sparkContext.broadcast(load(model))
    at = coded.columns.index("ids")
    places = [coded.columns.index(c) for c in carry]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(shared.value)
        for batch in batches:
            texts = [None if r is None else coder.decode(r) for r in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in places), pa.array(texts, pa.string())], [*carry, "text"]
            )

    kinds = [f"`{c}` {coded.schema[c].dataType.simpleString()}" for c in carry]
    return coded.mapInArrow(run, ", ".join([*kinds, "text string"]))


def encode_documents(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """One row per document: doc_id, ids, n_ids, round_trip.

    Repeated rows stay rows, an empty table gives none; other columns are ignored.
    """
    coded = encode(docs.select("doc_id", "text"), ["doc_id"], model)
    return coded.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "round_trip")
