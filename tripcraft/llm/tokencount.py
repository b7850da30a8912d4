"""Token counts without tokens: a count-only Viterbi over a unigram vocabulary.

The pieces and scores of a public SentencePiece file are taken as a unigram vocabulary (control, unknown and
byte pieces are no matches). The text is prepared as that library does: a space in front, spaces as U+2581.
An Aho-Corasick automaton enumerates the pieces that end at each character, longest first; the dynamic
programme keeps the best score and the piece count of every prefix, nothing else. Ties are the
tokenizer's: a later candidate replaces the best only if it is strictly better, and candidates come in the
order of their start, so the longest piece wins. A character that is no piece costs the lowest score less
10 and counts one token per UTF-8 byte (byte fallback). Scores are whole numbers, so sums are exact.

No piece of the vocabulary crosses from another character into U+2581, from a letter or digit into ASCII
punctuation (the few that do are looked up when the vocabulary is loaded), or holds a line break, so a
text's path is the sum of its pieces between such places, and each worker remembers the pieces it has seen.

Defined results: a null or empty text has 0 tokens and score 0; repeated rows repeat.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripcraft.llm.common import held, sliced, table

SPACE = "▁"
UNKNOWN = 10.0  # below the lowest score
CACHE = 600_000  # pieces a worker remembers
KEEP_LENGTH = 64
_PUNCTUATION = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


def default_vocabulary() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def load(path: str) -> list[tuple[str, float]]:
    """(piece, score) of the ordinary pieces of a SentencePiece file."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]


class Counter:
    """Best path's (score, number of tokens) of a text."""

    def __init__(self, pieces: list[tuple[str, float]]):
        import ahocorasick
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown = min((s for _, s in pieces), default=0.0) - UNKNOWN
        joined = [a + b for p, _ in pieces for a, b in zip(p, p[1:], strict=False)]
        self.spaces = not any(b == SPACE and a != SPACE for a, b in joined)
        self.breaks = not any("\n" in p for p, _ in pieces)
        self.crossing = {a for a, b in joined if b in _PUNCTUATION and a.isalnum()}
        # complex numbers hold score and count, so that one sum() adds both
        self.seen: dict[str, complex] = {}
        self.after: dict[str, complex] = {}  # pieces that follow U+2581

    def path(self, piece: str) -> complex:
        """The programme itself: score + count j of a prepared string."""
        n = len(piece)
        best, count = [0.0] * (n + 1), [0] * (n + 1)
        matches = self.automaton.iter(piece)
        end, match = next(matches, (n, None))
        for e in range(n):
            top = None
            tokens, single = 0, False
            while end == e and match is not None:  # longest first
                length, score = match
                s = best[e + 1 - length] + score
                if top is None or s > top:
                    top, tokens = s, count[e + 1 - length] + 1
                single |= length == 1
                end, match = next(matches, (n, None))
            if not single and (top is None or best[e] + self.unknown > top):
                top, tokens = best[e] + self.unknown, count[e] + len(piece[e].encode("utf-8", "replace"))
            best[e + 1], count[e + 1] = top, tokens
        return complex(best[n], count[n])

    def _piece(self, piece: str) -> complex:
        """A new piece, cut at line breaks and before punctuation where no vocabulary piece crosses."""
        total = 0j
        for k, line in enumerate(piece.split("\n") if self.breaks else [piece]):
            if k:
                total += self._known("\n")
            core = line.rstrip(_PUNCTUATION)
            if len(core) < len(line) and core[-1:].isalnum() and core[-1] not in self.crossing:
                total += self._known(core) + self._known(line[len(core):])
            elif line:
                total += self._known(line)
        return total

    def _known(self, piece: str) -> complex:
        found = self.seen.get(piece)
        if found is None:
            found = self.path(piece)
            if len(piece) <= KEEP_LENGTH:
                self.seen[piece] = found
        return found

    def _after(self, piece: str) -> complex:
        found = self._piece(SPACE + piece)
        if len(piece) <= KEEP_LENGTH:
            self.after[piece] = found
        return found

    def count(self, text: str | None) -> tuple[int, float]:
        """(tokens, score) of a whole text."""
        if not text:
            return 0, 0.0
        if len(self.seen) + len(self.after) > CACHE:
            self.seen.clear()
            self.after.clear()
        text = text.replace(SPACE, " ")
        if not self.spaces:
            total = self.path(SPACE + text.replace(" ", SPACE))
        else:
            pieces = text.split(" ")
            if "" in pieces:  # runs of spaces belong together
                joined: list[str] = []
                run = 0
                for p in pieces:
                    run += 1
                    if p:
                        joined.append(SPACE * (run - 1) + p)
                        run = 0
                total = sum(map(self._after, joined), self.path(SPACE * run) if run else 0j)
            else:
                found = list(map(self.after.get, pieces))
                if None in found:
                    found = [self._after(p) if x is None else x for p, x in zip(pieces, found, strict=True)]
                total = sum(found, 0j)
        return int(total.imag), total.real


def token_counts(docs: DataFrame, text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """``docs`` as a column ``row`` (without the text) plus ``n_tokens`` and the path's ``score``."""
    shared = docs.sparkSession.sparkContext.broadcast(load(vocabulary or default_vocabulary()))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns if c != text)).alias("row"), F.col(f"`{text}`").alias("t"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = shared.value
        count = held(("counts", len(pieces), hash(tuple(pieces))), lambda: Counter(pieces)).count
        for b in sliced(batches, "t"):
            found = [count(t) for t in b.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("row"), pa.array([x[0] for x in found], pa.int64()),
                                              pa.array([x[1] for x in found], pa.float64())], names=["row", "n_tokens", "score"])

    return rows.mapInArrow(run, rows.select("row", F.lit(0).cast("long").alias("n_tokens"), F.lit(0.0).alias("score")).schema)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents", "doc_id", "text")).select("row.doc_id", "n_tokens", "score")
