"""SentencePiece encoding and decoding with the pieces and scores of a model file.

A text is normalised as the model says (spaces become U+2581, one is put in front). Its pieces
are the segmentation with the greatest sum of scores: an Aho-Corasick automaton over all pieces
reads the text once, and at each place every piece that ends there, found over the output
links, relaxes the best score. A character no piece covers scores `UNKNOWN_PENALTY` below the
least piece; with byte fallback it is written as its UTF-8 bytes. Ties go to the piece that starts first.

No piece but a run of U+2581 has one inside or at its end, so words can be segmented alone and
a worker remembers the pieces of words it has met.

For a model of merges this is the best segmentation under its scores, which may differ from the
order of its merges. `decode` gives the normalised text back; for a model that normalises by
identity that is the text itself, unless it holds U+2581.

A null or empty text has no pieces and decodes to ''. Repeated rows and ids are kept.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import small_batches, texts

UNKNOWN_PENALTY = 10.0
#: Words a worker remembers; forgotten all at once beyond that.
REMEMBERED = 250_000
SPACE = "▁"

_UNREACHED = float("-inf")
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """Encodes and decodes by one model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(len(self.names)) if model.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        self.silent = {i for i in range(len(self.names)) if model.is_control(i)}
        self.unknown = model.unk_id()
        #: Pieces that are not written as they are named.
        self.odd = self.byte_of.keys() | self.silent
        self.automaton, least = ahocorasick.Automaton(), 0.0
        for i, name in enumerate(self.names):
            if i in self.byte_of or i in self.silent or model.is_unknown(i) or model.is_unused(i):
                continue
            score = model.get_score(i)
            if name.strip(SPACE) and SPACE in name.lstrip(SPACE):
                raise ValueError(f"piece {i} goes on after a space")
            least = min(least, score) if score > -1e8 else least
            self.automaton.add_word(name, (i, len(name), score))
        self.automaton.make_automaton()
        self.unknown_score = least - UNKNOWN_PENALTY
        self.met: dict[str, tuple[int, ...]] = {}

    def normalized(self, text: str) -> str:
        """As the model's rule says, spaces still marked by U+2581."""
        if not text:
            return ""
        return self.model.normalize(text)

    def best(self, word: str) -> tuple[int, ...]:
        """The single-pass search over one word."""
        n = len(word) + 1
        score, back, piece = [_UNREACHED] * n, [0] * n, [self.unknown] * n
        score[0] = 0.0
        done = 0  # the last place whose score is final
        for end, (i, length, own) in self.automaton.iter(word):
            while done < end:  # places where no piece of one character ends
                done += 1
                if score[done] == _UNREACHED:
                    score[done], back[done] = score[done - 1] + self.unknown_score, done - 1
            start = end + 1 - length
            total = score[start] + own
            if total > score[end + 1]:
                score[end + 1], back[end + 1], piece[end + 1] = total, start, i
        while done < n - 1:
            done += 1
            if score[done] == _UNREACHED:
                score[done], back[done] = score[done - 1] + self.unknown_score, done - 1
        out, at = [], n - 1
        while at:
            if piece[at] == self.unknown and self.bytes:
                out.extend(self.bytes[b] for b in reversed(word[back[at]:at].encode()))
            else:
                out.append(piece[at])
            at = back[at]
        return tuple(reversed(out))

    def encode(self, text: str) -> list[int]:
        words = _WORD.findall(self.normalized(text))
        met = self.met
        found = list(map(met.get, words))
        if None in found:
            if len(met) >= REMEMBERED:
                met.clear()
            for at, pieces in enumerate(found):
                if pieces is None:
                    word = words[at]
                    pieces = found[at] = met.get(word) or self.best(word)
                    if len(word) <= 64:
                        met[word] = pieces
        return list(chain.from_iterable(found))

    def decode(self, ids) -> str:
        """The text of the pieces, without the space put in front."""
        if not self.odd.isdisjoint(ids):
            return self._decode_bytes(ids)
        return "".join(map(self.names.__getitem__, ids)).replace(SPACE, " ").removeprefix(" ")

    def _decode_bytes(self, ids) -> str:
        out, held = [], bytearray()
        for i in ids:
            if i in self.byte_of:
                held.append(self.byte_of[i])
                continue
            if held:
                out.append(held.decode("utf-8", "replace"))
                held.clear()
            if i not in self.silent:
                out.append(self.names[i])
        out.append(held.decode("utf-8", "replace"))
        return "".join(out).replace(SPACE, " ").removeprefix(" ")


@lru_cache(maxsize=2)
def pieces_of(path: str) -> Pieces:
    return Pieces(path)


def with_pieces(df: DataFrame, path: str, text: str = "text", ids: str = "ids",
                decoded: str = "decoded") -> DataFrame:
    """All columns of `df`, `ids` of its texts and what the ids decode to.

    Columns that already have these names are replaced.
    """
    small_batches(df.sparkSession)
    df = df.drop(ids, decoded)
    schema = T.StructType([*df.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType())),
                           T.StructField(decoded, T.StringType())])

    def coded(batches):
        pieces = pieces_of(path)
        for batch in batches:
            found = [pieces.encode(t or "") for t in batch.column(text).to_pylist()]
            ends = np.cumsum([0, *map(len, found)], dtype=np.int32)
            flat = np.fromiter(chain.from_iterable(found), np.int32, int(ends[-1]))
            columns = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                       pa.array([pieces.decode(f) for f in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns],
                                             [*batch.schema.names, ids, decoded])

    return df.mapInArrow(coded, schema)


def encoded(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids, n_pieces, and whether decoding gives the text back; of every row."""
    rows = with_pieces(texts(docs, id, text), path)
    return rows.select("doc_id", F.size("ids").alias("n_pieces"), "ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       (F.col("decoded") == F.col("text")).alias("lossless"))
