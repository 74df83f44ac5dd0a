"""Token counts under a unigram vocabulary, with the forward scores of shared prefixes computed once.

A pre-token is a word with the vocabulary's word mark before it. Its tokens are the pieces of
its best segmentation, by the sum of the pieces' log probabilities. The distinct new pre-tokens
of a batch are walked in sorted order, which is a depth-first walk of their trie: the forward
scores along the current path are a stack, so a prefix that many words share is scored once, and
the count at a word's end is stored for every later occurrence.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gradeworks.llm.common import arrow_schema, as_batch, map_batches

VOCABULARY = "piece_bpe_32k.model"
WORD_MARK = "▁"
PRE_TOKEN = re.compile(r"\S+")
MAX_STORED = 400_000
LONGEST_STORED = 64
ROWS_AT_ONCE = 500
SCHEMA = "doc_id bigint, n_pretokens bigint, n_tokens bigint, n_bytes bigint"


@dataclass(frozen=True)
class UnigramVocabulary:
    """Log probability per piece; a character that no piece covers costs ``byte_score`` per UTF-8 byte."""

    scores: dict[str, float]
    byte_score: float


def zipf_vocabulary(pieces: Iterable[str]) -> UnigramVocabulary:
    """Pieces in order of their rank with Zipf's probabilities, since the files hold ranks only.

    A byte is less likely than any piece, so bytes are used only where no piece fits.
    """
    ranked = [p for p in dict.fromkeys(pieces) if p]
    total = sum(1 / (i + 1) for i in range(len(ranked))) or 1.0
    scores = {p: -math.log((i + 1) * total) for i, p in enumerate(ranked)}
    return UnigramVocabulary(scores, 2 * min(scores.values(), default=-1.0))


def load_vocabulary(name: str = VOCABULARY) -> UnigramVocabulary:
    """The public vocabulary file's ordinary pieces, without control and byte pieces."""
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    return zipf_vocabulary(model.id_to_piece(i) for i in sorted(ids, key=lambda i: (-model.get_score(i), i)))


class TrieCounter:
    """Token counts of pre-tokens. Stored counts are bounded in number and in word length."""

    def __init__(self, vocabulary: UnigramVocabulary):
        self.byte_score = vocabulary.byte_score
        # endings of pieces that are no pieces themselves have score 0, above every log probability
        self.endings = {p[i:]: 0.0 for p in vocabulary.scores for i in range(1, len(p))} | vocabulary.scores
        self.stored: dict[str, int] = {}

    def add(self, words: Iterable[str]) -> None:
        """Score new words in trie order and store the count at each end.

        ``best[d]`` and ``count[d]`` belong to the prefix of d characters of the current path.
        Of equal scores the segmentation with fewer tokens counts.
        """
        ending, stored = self.endings.get, self.stored
        best, count = [0.0], [0]
        path = ""
        for word in sorted(words):
            marked = WORD_MARK + word
            shared = 0
            for a, b in zip(path, marked, strict=False):
                if a != b:
                    break
                shared += 1
            del best[shared + 1 :], count[shared + 1 :]
            for end in range(shared + 1, len(marked) + 1):
                char = marked[end - 1]
                score = ending(char)
                if score:
                    # bytes are less likely than any piece, so they need no look here
                    top, least = best[-1] + score, count[-1] + 1
                else:
                    size = 1 if char == WORD_MARK else len(char.encode("utf-8", "replace"))
                    top, least = best[-1] + self.byte_score * size, count[-1] + size
                start = end - 2
                while start >= 0 and (score := ending(marked[start:end])) is not None:
                    if score:
                        score += best[start]
                        if score > top or (score == top and count[start] + 1 < least):
                            top, least = score, count[start] + 1
                    start -= 1
                best.append(top)
                count.append(least)
            path = marked
            stored[word] = count[len(marked)]

    def total(self, texts: list[str]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        split = [PRE_TOKEN.findall(t) for t in texts]
        stored = self.stored
        new = {w for words in split for w in words if w not in stored}
        self.add(new)
        out = [(len(words), sum(map(stored.__getitem__, words))) for words in split]
        for w in [w for w in new if len(w) > LONGEST_STORED]:
            del stored[w]
        if len(stored) > MAX_STORED:
            stored.clear()
        return out


def count_tokens(docs: DataFrame, vocabulary: UnigramVocabulary) -> DataFrame:
    """Pre-tokens, tokens and UTF-8 bytes of every whole text of ``docs`` (doc_id, text).

    Pre-tokens are runs of characters that are not white space. A null or empty text has none;
    null ids and repeated rows are kept; other columns are left out. Narrow: no row moves.
    """
    schema = arrow_schema(SCHEMA)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = TrieCounter(vocabulary)
        for batch in batches:
            for part in (batch.slice(i, ROWS_AT_ONCE) for i in range(0, batch.num_rows, ROWS_AT_ONCE)):
                ids, texts = part.column(0).to_pylist(), [t or "" for t in part.column(1).to_pylist()]
                totals = counter.total(texts)
                rows = ((i, *n, len(t.encode("utf-8", "replace"))) for i, t, n in zip(ids, texts, totals, strict=True))
                yield as_batch(rows, schema)

    return map_batches(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), work, SCHEMA)


def corpus_totals(counts: DataFrame) -> DataFrame:
    """One row: documents, pre-tokens, tokens and bytes of the whole corpus."""
    return counts.agg(
        F.count(F.lit(1)).alias("n_docs"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_pretokens", "n_tokens", "n_bytes")],
    )
