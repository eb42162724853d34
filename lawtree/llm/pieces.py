"""SentencePiece encoding and decoding with a given vocabulary.

An Aho-Corasick automaton over the pieces reads a text once. At each position its output links
name all pieces that end there; each of them relaxes the best score of the position, so one pass
finds the segmentation of the highest total score. A character that is no piece costs more than
any piece and is written as its UTF-8 bytes, so every text decodes to itself.

No piece that can win holds a space or line feed behind its first character, so the best paths of
the parts that start there are independent of each other and can be remembered.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import deque

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lawtree.llm.common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
# The space mark of the vocabulary format, and what an unknown character costs
# beyond the worst piece.
MARK = "▁"
UNKNOWN_COST = 10.0
# Pieces marked as unusable carry a score far below all others.
UNUSABLE = -1e8
# Added to a merge rank, so that the first pieces do not weigh too much; scores are multiples of STEP.
SHIFT, STEP = 10.0, 2.0**-20
# Parts remembered, in two generations, so that common ones stay.
REMEMBERED = 200_000
ROWS = 256

PARTS = re.compile(r"[ \n]?[^ \n]+|[ \n]")


def vocabulary(path: str = MODEL) -> list[tuple[str, float, bool]]:
    """(piece, score, whether it is a byte) by id; a piece of no text is the empty string."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    out = []
    for i in range(model.vocab_size()):
        plain = not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i))
        out.append((model.id_to_piece(i) if plain else "", model.get_score(i), model.is_byte(i)))
    return out


def log_probabilities(entries: list[tuple[str, float, bool]]) -> list[tuple[str, float, bool]]:
    """``entries`` with logarithms of probabilities as scores.

    Vocabularies of merged pairs hold ranks instead, whole numbers from 0 down, of which sums mean
    nothing; a piece then has a share in inverse proportion to its rank. Scores are rounded to
    multiples of STEP: their sums are exact, whatever parts a text is cut into.
    """
    scores = [s for p, s, b in entries if p and not b and s > UNUSABLE]
    if not any(s != int(s) for s in scores):
        total = math.log(sum(1 / (SHIFT - s) for s in scores)) if scores else 0.0
        entries = [(p, -math.log(SHIFT - s) - total if UNUSABLE < s <= 0 else s, b) for p, s, b in entries]
    return [(p, round(s / STEP) * STEP, b) for p, s, b in entries]


class Encoder:
    def __init__(self, entries: list[tuple[str, float, bool]]):
        self.entries = entries = log_probabilities(entries)
        self.bytes = [b""] * len(entries)
        self.byte_ids = [0] * 256
        pieces: dict[str, tuple[int, float]] = {}
        for i, (piece, score, is_byte) in enumerate(entries):
            if is_byte:
                value = int(piece[3:5], 16)
                self.bytes[i], self.byte_ids[value] = bytes([value]), i
            elif piece:
                text = piece.replace(MARK, " ")
                self.bytes[i] = text.encode()
                if score > UNUSABLE and " " not in text[1:] and "\n" not in text:
                    pieces[text] = (i, score)
        if MARK in (names := [e[0] for e in entries]):
            # A space that belongs to no other piece, as good as the worst of them.
            pieces.setdefault(" ", (names.index(MARK), min((s for _, s in pieces.values()), default=0.0)))
        inside = {b for text in pieces for a, b in zip(text, text[1:]) if a.isalnum()}
        # Signs that no piece has after a letter or digit: at the end of a part they stand alone.
        self.signs = set(".,;:!?") - inside
        self.unknown = min((s for _, s in pieces.values()), default=0.0) - UNKNOWN_COST
        self._build(pieces)
        self.known: dict[str, tuple[bytes, float]] = {}
        self.older: dict[str, tuple[bytes, float]] = {}

    def _build(self, pieces: dict[str, tuple[int, float]]) -> None:
        """States with their transitions, failure links, and all pieces that end in a state."""
        self.next: list[dict[str, int]] = [{}]
        own: list[tuple[int, float, int] | None] = [None]  # length, score, id
        for text, (i, score) in pieces.items():
            state = 0
            for c in text:
                if c not in self.next[state]:
                    self.next[state][c] = len(self.next)
                    self.next.append({})
                    own.append(None)
                state = self.next[state][c]
            own[state] = (len(text), score, i)
        self.fail = [0] * len(self.next)
        # Output links, followed to their end: the pieces that end in a state, the longest first.
        self.output: list[tuple] = [()] * len(self.next)
        queue = deque(self.next[0].values())
        for state in queue:
            self.output[state] = (own[state],) if own[state] else ()
        while queue:
            state = queue.popleft()
            for c, target in self.next[state].items():
                fallen = self.fail[target] = self._move(self.fail[state], c)
                self.output[target] = ((own[target],) if own[target] else ()) + self.output[fallen]
                queue.append(target)

    def _move(self, state: int, c: str) -> int:
        while state and c not in self.next[state]:
            state = self.fail[state]
        return self.next[state].get(c, 0)

    def best(self, part: str) -> tuple[array, float]:
        """Ids and score of the best segmentation; among equals the longer last piece wins."""
        scores, last = [0.0], [None]
        state, following, output, unknown = 0, self.next, self.output, self.unknown
        for end, c in enumerate(part, 1):
            target = following[state].get(c)
            state = self._move(state, c) if target is None else target
            top, via = -1e300, None
            for piece in output[state]:
                score = scores[end - piece[0]] + piece[1]
                if score > top:
                    top, via = score, piece
            # The shortest piece comes last; without one of one character, the character is unknown.
            if not output[state] or output[state][-1][0] > 1:
                score = scores[end - 1] + unknown
                if score > top:
                    top, via = score, None
            scores.append(top)
            last.append(via)
        ids, end = [], len(part)
        while end:
            if (piece := last[end]) is None:
                ids.extend(self.byte_ids[b] for b in reversed(part[end - 1].encode()))
                end -= 1
            else:
                ids.append(piece[2])
                end -= piece[0]
        ids.reverse()
        return array("i", ids), scores[-1]

    def _found(self, part: str) -> tuple[bytes, float]:
        found = self.older.get(part)
        if found is None:
            if part[-1] in self.signs and part[-2:-1].isalnum():
                (ids, score), (ids_sign, score_sign) = (self.known.get(p) or self._found(p) for p in (part[:-1], part[-1]))
                found = ids + ids_sign, score + score_sign
            else:
                ids, score = self.best(part)
                found = ids.tobytes(), score
        if len(part) < 64:
            if len(self.known) >= REMEMBERED:
                self.known, self.older = {}, self.known
            self.known[part] = found
        return found

    def encode(self, text: str) -> tuple[array, float]:
        """Ids and total score. The text gets one leading space, as the vocabulary expects."""
        chosen, total = bytearray(), 0.0
        for part in PARTS.findall(" " + text) if text else ():
            ids, score = self.known.get(part) or self._found(part)
            chosen += ids
            total += score
        return array("i", bytes(chosen)), total

    def decode(self, ids) -> str:
        return b"".join(map(self.bytes.__getitem__, ids))[1:].decode()


def _encoder(entries: list):
    def run(batches):
        encoder = Encoder(entries)
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                counts, scores, same, offsets, ids = [], [], [], [0], array("i")
                for text in part.column("text").to_pylist():
                    encoded, total = encoder.encode(text or "")
                    counts.append(len(encoded))
                    scores.append(total)
                    same.append(encoder.decode(encoded) == (text or ""))
                    ids += encoded
                    offsets.append(len(ids))
                tokens = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                columns = [part.column("doc_id"), pa.array(counts, pa.int64()), pa.array(scores, pa.float64())]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(same, pa.bool_()), tokens],
                    names=["doc_id", "n_tokens", "score", "round_trip", "token_ids"],
                )

    return run


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, score, round_trip, token_ids) of every row of ``docs``.

    ``round_trip`` tells whether the ids decode to the whole text again. A null or empty text has
    no tokens and score 0; columns but doc_id and text are ignored. The vocabulary file is read
    on the driver and sent along.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_tokens long, score double, round_trip boolean, token_ids array<int>"
    return rows.mapInArrow(_encoder(vocabulary(model)), schema)


def _decoder(entries: list):
    def run(batches):
        encoder = Encoder(entries)
        for batch in batches:
            texts = [None if ids is None else encoder.decode(ids) for ids in batch.column("token_ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return run


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows with token_ids; null ids give a null text."""
    rows = encoded.select("doc_id", "token_ids")
    return rows.mapInArrow(_decoder(vocabulary(model)), "doc_id long, text string")


def stage(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    return encode(docs)


def op5_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encode(table(spark, folder, "documents"))
