"""SentencePiece encoding and decoding by Viterbi search over a trie of marked words."""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import bounded_batches, tidy

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: A marked word: spaces (the marks) and what follows up to the next space or line end.
MARKED = re.compile(r" +[^ \n]*|[^ \n]+|\n")


class PieceModel:
    """Pieces with log-probabilities, and bytes for characters that no piece covers.

    The file's scores are negative merge ranks, so the piece of rank r gets probability 1 / ((r + 1) * H), H the sum
    of all 1 / (r + 1). In here the mark is a space, so a literal mark in a text can only be spelled in bytes.
    """

    def __init__(self, pieces: dict[str, tuple[int, float]], byte_ids: list[int], surface: dict[int, bytes]):
        self.pieces, self.byte_ids, self.surface = pieces, byte_ids, surface
        self.tails = dict.fromkeys(p[i:] for p in pieces for i in range(len(p))) | pieces  # None: only the end of a piece
        self.byte_score = min((s for _, s in pieces.values()), default=-10.0) - 10

    @classmethod
    def from_bytes(cls, data: bytes) -> PieceModel:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=data)
        byte_ids, surface, plain = [0] * 256, {}, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(piece[3:5], 16)] = i
                surface[i] = bytes([int(piece[3:5], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                piece = piece.replace("▁", " ")
                plain.append((piece, i, sp.get_score(i)))
                surface[i] = piece.encode()
        plain.sort(key=lambda x: (-x[2], x[1]))
        norm = math.log(sum(1 / (r + 1) for r in range(len(plain)))) if plain else 0.0
        return cls({p: (i, -math.log(r + 1) - norm) for r, (p, i, _) in enumerate(plain)}, byte_ids, surface)

    def encode_words(self, words: list[str]) -> dict[str, list[int]]:
        """Best ids of each distinct word: sorted words are a depth-first walk of their trie, and what two neighbours
        share at the front keeps its forward scores and back pointers. Ties go to the longer last piece."""
        out, tails, last = {}, self.tails, ""
        scores, back = [0.0], [(0, None)]
        for word in sorted(words):
            n = min(len(word), len(last))
            same = 0
            while same < n and word[same] == last[same]:
                same += 1
            del scores[same + 1 :], back[same + 1 :]
            for end in range(same + 1, len(word) + 1):
                best, via = -math.inf, None
                for start in range(end - 1, -1, -1):
                    found = tails.get(word[start:end], 0)
                    if found is None:
                        continue
                    if not found:  # nothing that ends here goes back this far
                        break
                    if (s := scores[start] + found[1]) >= best:
                        best, via = s, (start, found[0])
                if via is None:
                    best = scores[end - 1] + self.byte_score * len(word[end - 1].encode())
                    via = (end - 1, None)
                scores.append(best)
                back.append(via)
            ids, at = [], len(word)
            while at:
                start, piece_id = back[at]
                if piece_id is None:
                    ids.extend(self.byte_ids[b] for b in reversed(word[start:at].encode()))
                else:
                    ids.append(piece_id)
                at = start
            out[word] = ids[::-1]
            last = word
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.surface.__getitem__, ids)).decode("utf-8", "replace")[1:]


@functools.lru_cache(maxsize=2)
def _model(data: bytes) -> PieceModel:
    return PieceModel.from_bytes(data)


def _model_bytes(df: DataFrame, path: str):
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for start in range(0, b.num_rows, rows):
            yield b.slice(start, rows)


def encode(docs: DataFrame, model_path: str = MODEL, cache: int = 100_000, verify: bool = False) -> DataFrame:
    """(doc_id, text) -> doc_id, text, piece_ids, one row per input row; other columns are ignored. With verify, text is
    replaced by round_trip: whether decoding the ids gives the text back.

    A space is put before each text (decoding takes it away), so "" has the ids of one space; a null text has null ids.
    The model file (of fixed size) is read by the driver and broadcast; each task keeps at most `cache` encoded words
    between chunks. No shuffle.
    """
    data = _model_bytes(docs, model_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = _model(data.value), {}
        for b in _slices(batches):
            texts = b.column(1).to_pylist()
            words = [MARKED.findall(" " + t) if t is not None else None for t in texts]
            if len(known) > cache:
                known = {}
            known.update(model.encode_words(list(set(chain.from_iterable(w for w in words if w)).difference(known))))
            ids = [None if w is None else np.fromiter(chain.from_iterable(map(known.__getitem__, w)), np.int32) for w in words]
            sizes = np.array([0 if x is None else len(x) for x in ids], np.int64)
            offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
            values = pa.array(np.concatenate([x for x in ids if x is not None]) if sizes.any() else np.zeros(0, np.int32))
            null = pa.array(np.array([x is None for x in ids], bool))
            ids_column = pa.ListArray.from_arrays(offsets, values, mask=null)
            if verify:
                same = [x is None or model.decode(x.tolist()) == t for x, t in zip(ids, texts, strict=True)]
                yield pa.RecordBatch.from_arrays([b.column(0), ids_column, pa.array(same, pa.bool_())], ["doc_id", "piece_ids", "round_trip"])
            else:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), ids_column], ["doc_id", "text", "piece_ids"])

    return bounded_batches(docs).select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        tidy(run), "doc_id long, piece_ids array<int>, round_trip boolean" if verify else "doc_id long, text string, piece_ids array<int>")


def decode(encoded: DataFrame, model_path: str = MODEL) -> DataFrame:
    """(doc_id, piece_ids, and any other columns) -> the same with decoded string (replaced if there is one).

    Null ids decode to null; ids that are not pieces raise a KeyError.
    """
    data = _model_bytes(encoded, model_path)
    rest = [c for c in encoded.columns if c not in ("decoded", "piece_ids")]
    src = encoded.select("piece_ids", *rest)
    kinds = {f.name: f.dataType.simpleString() for f in src.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode_ids = _model(data.value).decode
        for b in _slices(batches):
            ids = b.column(0)
            bounds = ids.offsets.to_numpy()
            values = ids.values.slice(bounds[0], bounds[-1] - bounds[0]).to_numpy(zero_copy_only=False)  # of these rows only
            ends = (bounds - bounds[0]).tolist()
            texts = [decode_ids(values[s:e].tolist()) if ok else None for s, e, ok in zip(ends, ends[1:], ids.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], [*b.schema.names, "decoded"])

    schema = ", ".join(f"`{c}` {kinds[c]}" for c in src.columns) + ", decoded string"
    return bounded_batches(src).mapInArrow(tidy(run), schema)
