"""Token counts by unigram scores over a trie of distinct pre-tokens."""

from __future__ import annotations

import base64
import functools
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, id_number, id_text, text_chunks, tidy

VOCAB = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pre-token pattern published with this vocabulary.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class UnigramCounter:
    """Counts tokens of pre-tokens along the path of highest total log-probability.

    The file holds ranks, so the token of rank r has probability 1 / ((r + 1) * H), with H the sum of all 1 / (r + 1).
    Equal scores go to fewer tokens.
    """

    def __init__(self, ranks: dict[bytes, int]):
        norm = math.log(sum(1 / (r + 1) for r in ranks.values()))
        self.score = {t: -math.log(r + 1) - norm for t, r in ranks.items()}
        self.tails = dict.fromkeys(t[i:] for t in ranks for i in range(len(t))) | self.score  # None: only the end of a token
        self.floor = min(self.score.values(), default=-10.0) - 5

    @classmethod
    def from_bytes(cls, data: bytes) -> UnigramCounter:
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, data.splitlines()) if a})

    def step(self, word: bytes, end: int, scores: list[float], counts: list[int]) -> tuple[float, int]:
        """Forward score and token count of word[:end], from those of its shorter prefixes."""
        best, n, tails = -math.inf, 0, self.tails
        for start in range(end - 1, -1, -1):
            s = tails.get(word[start:end], 1)
            if s is None:
                continue
            if s == 1:  # no log-probability: nothing that ends here goes back this far
                break
            total = scores[start] + s
            if total >= best and (total > best or counts[start] + 1 < n):
                best, n = total, counts[start] + 1
        if n == 0:  # a byte that the vocabulary lacks is a token of its own
            best, n = scores[end - 1] + self.floor, counts[end - 1] + 1
        return best, n

    def count_all(self, words: list[str]) -> dict[str, int]:
        """Insert the words in a trie, in order, so that it is walked depth-first: of its nodes those of the open path are
        held, with their forward scores and counts; each node is scored once, and the count of a word is kept at its end.
        However long a word, no more than its own path is in memory."""
        out: dict[str, int] = {}
        path, scores, counts = b"", [0.0], [0]
        for word, text in sorted((text.encode(), text) for text in words):
            shared, most = 0, min(len(word), len(path))
            while shared < most and word[shared] == path[shared]:
                shared += 1
            del scores[shared + 1 :], counts[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                score, count = self.step(word, end, scores, counts)
                scores.append(score)
                counts.append(count)
            out[text] = counts[-1]
            path = word
        return out


@functools.lru_cache(maxsize=2)
def _counter(data: bytes) -> UnigramCounter:
    return UnigramCounter.from_bytes(data)


def token_counts(docs: DataFrame, vocab_path: str = VOCAB, pattern: str = PATTERN, cache: int = 200_000) -> DataFrame:
    """(doc_id, text) -> doc_id, n_pretokens, n_tokens, one row per input row.

    The vocabulary file (of fixed size) is read by the driver and broadcast. Each task inserts the distinct pre-tokens
    of some million characters in a trie and keeps at most `cache` counts between chunks. No shuffle.
    Null and empty texts have 0 tokens; other columns are ignored; repeated rows give repeated rows.
    """
    with open(vocab_path, "rb") as f:
        data = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import regex

        counter, find, known = _counter(data.value), regex.compile(pattern).findall, {}
        for b in text_chunks(batches):
            tokens = [find(t) if t else [] for t in b["text"]]
            if len(known) > cache:
                known = {}
            new = set().union(*tokens).difference(known)
            known.update(counter.count_all(list(new)))
            get = known.__getitem__
            yield pd.DataFrame({
                "doc_id": b["doc_id"].to_numpy(),
                "n_pretokens": np.array([len(x) for x in tokens], np.int64),
                "n_tokens": np.array([sum(map(get, x)) for x in tokens], np.int64),
            })

    return id_number(bounded_batches(docs).select(id_text(), F.col("text").cast("string")).mapInPandas(
        tidy(run), "doc_id string, n_pretokens long, n_tokens long"))
