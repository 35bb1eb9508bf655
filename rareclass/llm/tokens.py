"""Token counts without tokens: Viterbi over a unigram vocabulary, carrying score and count only."""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import rename_clashes

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
# A character without a piece costs this much more than the worst piece, as unigram tokenizers have it.
UNKNOWN_PENALTY = 10.0
# Distinct stretches whose result a worker remembers.
MEMORY = 500_000

_SPACE = "▁"
_STRETCH = re.compile(f"{_SPACE}*[^{_SPACE}]+|{_SPACE}+")


class CountingViterbi:
    """Best score and piece count under ``pieces`` (text -> score); with ``byte_fallback`` an unknown character counts
    its UTF-8 bytes.

    Aho-Corasick lists the pieces that end at each character, longest first.  At every end the best sum wins, and a
    later candidate must be strictly better: among equals the longest last piece stays, as unigram tokenizers do it.
    """

    def __init__(self, pieces: dict[str, float], byte_fallback: bool = True):
        self.finder = ahocorasick.Automaton()
        for piece, score in pieces.items():
            if piece:
                self.finder.add_word(piece, (len(piece), score))
        if pieces:
            self.finder.make_automaton()
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(pieces.values(), default=0.0) - UNKNOWN_PENALTY
        self.byte_fallback = byte_fallback
        # pieces that hold a space mark after another character forbid cutting the text before space marks
        self.cuttable = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        self.memory: dict[str, tuple[int, float, int]] = {}

    def walk(self, text: str) -> tuple[int, float, int]:
        """``pieces, score, unknown characters`` of a stretch."""
        n = len(text)
        best, count, odd = [0.0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        at = 0  # ends before this are settled

        def settle(upto: int) -> None:
            nonlocal at
            while at < upto:
                c = text[at]
                if c not in self.single:
                    score = best[at] + self.unknown
                    if best[at + 1] is None or score > best[at + 1]:
                        best[at + 1] = score
                        count[at + 1] = count[at] + (len(c.encode("utf-8", "surrogatepass")) if self.byte_fallback else 1)
                        odd[at + 1] = odd[at] + 1
                at += 1

        best[1:] = [None] * n
        for end, (length, score) in self.finder.iter(text):
            settle(end)
            start = end + 1 - length
            total = best[start] + score
            if best[end + 1] is None or total > best[end + 1]:
                best[end + 1], count[end + 1], odd[end + 1] = total, count[start] + 1, odd[start]
        settle(n)
        return count[n], best[n], odd[n]

    def count(self, text: str | None) -> tuple[int, float, int]:
        """Of a whole text: spaces become marks and one mark is put in front; empty or null gives 0."""
        if not text:
            return 0, 0.0, 0
        marked = _SPACE + text.replace(" ", _SPACE)
        if not self.cuttable:
            return self.walk(marked)
        total, score, odd = 0, 0.0, 0
        for stretch in _STRETCH.findall(marked):
            got = self.memory.get(stretch)
            if got is None:
                if len(self.memory) >= MEMORY:
                    self.memory.clear()
                got = self.walk(stretch)
                if len(stretch) <= 64:
                    self.memory[stretch] = got
            total += got[0]
            score += got[1]
            odd += got[2]
        return total, score, odd


@lru_cache(maxsize=2)
def from_file(model_file: str) -> CountingViterbi:
    """Pieces and scores of a public tokenizer file, read on the worker (control and byte pieces match no text)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
    odd = lambda i: sp.IsControl(i) or sp.IsUnknown(i) or sp.IsByte(i) or sp.IsUnused(i)
    return CountingViterbi({sp.IdToPiece(i): sp.GetScore(i) for i in range(sp.GetPieceSize()) if not odd(i)})


def token_counts(docs: DataFrame, model_file: str = MODEL_FILE, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_tokens, score, n_unknown, n_chars`` of every whole text.

    No token is ever made: the walk carries the best sum and its number of pieces.  Stretches between spaces are
    independent under the vocabulary, so each worker walks a distinct stretch once.  Null and empty texts count 0;
    repeated rows come back as often; an empty table gives no row; other columns are not read.
    """
    @F.pandas_udf("n_tokens long, score double, n_unknown long")
    def counted(texts: pd.Series) -> pd.DataFrame:
        model = from_file(model_file)
        return pd.DataFrame([model.count(t) for t in texts], columns=["n_tokens", "score", "n_unknown"]).astype(
            {"n_tokens": "int64", "score": "float64", "n_unknown": "int64"})

    base = rename_clashes(docs, [key, text]).toDF("doc_id", "text")
    n_chars = F.coalesce(F.char_length("text"), F.lit(0)).cast("long").alias("n_chars")
    return base.select("doc_id", counted("text").alias("c"), n_chars).select("doc_id", "c.*", "n_chars")
