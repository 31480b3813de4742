"""SentencePiece ids of whole texts, by a table of distinct marked words.

In a model none of whose pieces has a whitespace marker after another character, no merge can
cross from a word to the marker before the next one.  A text is then a sequence of marked words
(markers and the characters up to the next marker), each of which has the same ids wherever it
stands.  A task segments each distinct marked word once, keeps the ids in a table of bounded
size, and joins them by position.

The table belongs to a task, not to the whole corpus: a corpus-wide one would have to send every
position of every word through a shuffle, several times the input.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from wattlake.llm.words import sliced

MARKER = "▁"

#: Distinct marked words a task remembers; beyond that the table starts anew.
TABLE_WORDS = 200_000


def read_model(path: str) -> bytes:
    """The model file's bytes, which travel to the executors with the job."""
    with open(path, "rb") as file:
        return file.read()


def words_are_independent(model: bytes) -> bool:
    """Whether marked words can be segmented one by one under this model.

    Asked of the model are: no piece with a marker after another character, markers in front of
    words, one added in front of a text, no other change to white space, and no normalisation.
    """
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(model)
    rule = spec.normalizer_spec
    user_defined = 4
    return (
        any(p.piece == MARKER for p in spec.pieces)
        and not any(re.search(f"[^{MARKER}]{MARKER}", p.piece) for p in spec.pieces)
        and not any(p.type == user_defined for p in spec.pieces)
        and rule.add_dummy_prefix and rule.escape_whitespaces
        and not rule.remove_extra_whitespaces and not rule.precompiled_charsmap
        and not spec.trainer_spec.treat_whitespace_as_suffix
    )


def marked_words(text: str) -> list[str]:
    """The marked words, each without its first marker, which the library adds; the other
    markers as spaces.  Joined by one space they are the text again."""
    text = text.replace(MARKER, " ")
    words = text.split(" ")
    if "" not in words:
        return words
    # more than one marker: they belong to the word after them, at the end to none
    return [chunk[1:] for chunk in re.findall(r" +[^ ]*", f" {text}")] if text else []


class PieceTable:
    """Ids and decoded bytes of marked words, each segmented when first met."""

    def __init__(self, model: bytes, limit: int = TABLE_WORDS):
        self._library = sentencepiece.SentencePieceProcessor(model_proto=model)
        self._limit = limit
        self._table: dict[str, tuple[bytes, bytes]] = {}

    def look_up(self, texts: list[list[str]]) -> dict[str, tuple[bytes, bytes]]:
        """A table with all words of the texts."""
        if len(self._table) > self._limit:
            self._table = {}
        new = list({word for words in texts for word in words}.difference(self._table))
        for word, ids in zip(new, self._library.encode(new, num_threads=1), strict=True):
            if not word:  # a marker alone, which the library does not add to an empty text
                ids = [self._library.piece_to_id(MARKER)]
            decoded = self._library.decode(ids)
            self._table[word] = np.array(ids, "<u4").tobytes(), decoded.encode("utf-8", "surrogatepass")
        return self._table

    def ends(self) -> tuple[bytes, bytes]:
        return tuple(np.array([i], "<u4").tobytes() for i in (self._library.bos_id(), self._library.eos_id()))


def encode_and_decode(
    docs: DataFrame, model: bytes, text_col: str = "text", digests: bool = False
) -> DataFrame:
    """All columns of ``docs`` and the ids of each text, begin and end ids included.

    ``ids`` is binary: little-endian unsigned 32-bit integers.  ``decoded`` is what the library
    decodes from them.  With ``digests`` there are ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256`` instead, so that ids need not leave the task.

    A null or empty text has the two ends alone and decodes to the empty text.  White space of any
    length and place is kept; a marker character in a text counts as a space, as for the library.
    Repeated rows get the same ids; columns of ``docs`` named like results are replaced.
    """
    if not words_are_independent(model):
        raise ValueError("pieces of this model can cross white space")
    added = (
        {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"}
        if digests else {"ids": "binary", "decoded": "string"}
    )
    kept = [f for f in docs.schema.fields if f.name not in added and not (digests and f.name == text_col)]
    names = [f.name for f in kept]
    schema = StructType(list(kept))
    for name, kind in added.items():
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = PieceTable(model)
        begin, end = table.ends()
        for batch in batches:
            for part in sliced(batch, text_col):
                texts = [marked_words(t) if t else [] for t in part.column(text_col).to_pylist()]
                known = table.look_up(texts)
                ids = [b"".join([begin, *[known[w][0] for w in words], end]) for words in texts]
                decoded = [b" ".join([known[w][1] for w in words]) for words in texts]
                if digests:
                    new = [
                        pa.array([len(i) // 4 for i in ids], pa.int64()),
                        pa.array([hashlib.sha256(i).hexdigest() for i in ids], pa.string()),
                        pa.array([hashlib.sha256(d).hexdigest() for d in decoded], pa.string()),
                    ]
                else:
                    new = [pa.array(ids, pa.binary()), pa.array(decoded, pa.binary()).cast(pa.string())]
                columns = [part.column(n) for n in names] + new
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *added])

    return docs.mapInArrow(run, schema)
