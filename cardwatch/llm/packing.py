"""Concatenate and cut: documents as token ids end to end, cut into windows of one length.

First pass: every task tokenises its rows and notes each row's place in the task's own run of tokens. These rows
are written; the token totals of the tasks, one number each, are summed up to global offsets. Second pass: each
row adds its task's offset to its place and is cut at the window borders. No rows move between tasks, a
document that crosses borders leaves boundary records in each window, and only the last window is not full.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardwatch.llm.common import saved, small_or_shuffled

LENGTH = 4096
END_ID = 2
#: Words whose ids a worker remembers, in either of two generations.
REMEMBERED = 400_000
#: More tasks than this take their offsets by a shuffle join instead of a broadcast.
BROADCAST_TASKS = 100_000

#: Letters that may go to the model alone, if the tokenizer takes them one by one: Latin ones.
_LETTERS = [chr(c) for c in range(0x250) if chr(c).isalpha()]
#: Marks that may stand behind them: ASCII ones but the apostrophe, behind which letters can be a token.
_MARKS = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'")
#: A text that tells whether a tokenizer gives the ids of its words in a row: cases, marks, accents, runs of white space.
_PROBE = "The plain Words, and THE rest.  don't  x1 e\u0301t\u00e9 \u00c9T\u00c9*** a,% \u4e2d\u6587\nNew\t\tline, again .".encode()


class WordIds:
    """Token ids of texts by their words, as little-endian 32-bit bytes.

    For tokenizers whose pre-tokenizer drops white space and splits at it, the ids of a text are those of its
    words in a row. A word of Latin letters, each in the form that the tokenizer gives it, goes to the model alone, and the
    marks behind it are words of their own; any other word goes through the whole tokenizer. A tokenizer whose ids of a
    probing text are others than that (one that keeps white space, say) gets whole texts.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.marks = {"": b""}
        self.forms = self._letter_forms()
        self.simple = re.compile(f"([{re.escape(''.join(map(chr, self.forms)))}]+)([{re.escape(_MARKS)}]*)") if self.forms else None
        self.by_words = True
        self.by_words = self.ids(_PROBE) == self._whole(_PROBE)

    def _pieces(self, text: str) -> list[str]:
        """What the model would get, one by one."""
        if self.tokenizer.normalizer:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [p for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    def _letter_forms(self) -> dict[int, str]:
        """The forms of those letters that are one piece; none if all of them in a row are not one piece of these forms."""
        if not self.tokenizer.pre_tokenizer:
            return {}
        pieces = {ord(c): self._pieces(c) for c in _LETTERS}
        forms = {c: found[0] for c, found in pieces.items() if len(found) == 1}
        row = "".join(map(chr, forms))
        return forms if self._pieces(row) == [row.translate(forms)] else {}

    def _whole(self, word: bytes) -> bytes:
        ids = self.tokenizer.encode(word.decode("utf-8", "replace"), add_special_tokens=False).ids
        return np.array(ids, "<u4").tobytes()

    def _learn(self, word: bytes) -> bytes:
        found = self.old.get(word)
        if found is None:
            simple = self.simple and self.simple.fullmatch(word.decode("utf-8", "replace"))
            if simple:
                ids = [t.id for t in self.model.tokenize(simple[1].translate(self.forms))]
                marks = self.marks.get(simple[2])
                if marks is None:
                    marks = self._whole(simple[2].encode())
                    if len(simple[2]) < 4:  # so that few are kept
                        self.marks[simple[2]] = marks
                found = struct.pack(f"<{len(ids)}I", *ids) + marks
            else:
                found = self._whole(word)
        if len(self.young) >= REMEMBERED:
            self.old, self.young = self.young, {}
        self.young[word] = found
        return found

    def ids(self, text: bytes) -> bytes:
        if not self.by_words:
            return self._whole(text)
        known, learn = self.young.get, self._learn
        return b"".join([known(w) or learn(w) for w in text.split()])


_loaded: dict[str, WordIds] = {}


def _word_ids(path: str) -> WordIds:
    if path not in _loaded:
        _loaded[path] = WordIds(path)
    return _loaded[path]


def tokenise(docs: DataFrame, path: str, end_id: int = END_ID) -> DataFrame:
    """(doc_id, task, place, n, ids): ids of each row with the end id, and its place in the task's run.

    Ids are kept in two bytes where the vocabulary allows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _word_ids(path)
        small = max(words.tokenizer.get_vocab_size(), end_id + 1) <= 1 << 16
        end = np.array([end_id], "<u4").tobytes()
        task, place = TaskContext.get().partitionId(), 0
        for batch in batches:
            raw = pc.fill_null(batch.column("text").cast(pa.large_binary()), b"")
            ids, places, counts = [], [], []
            for value in raw:
                own = words.ids(value.as_py()) + end
                places.append(place)
                counts.append(len(own) // 4)
                place += counts[-1]
                ids.append(np.frombuffer(own, "<u4").astype("<u2").tobytes() if small else own)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array([task] * len(ids), pa.int32()), pa.array(places, pa.int64()),
                    pa.array(counts, pa.int64()), pa.array(ids, pa.binary()),
                ],
                names=["doc_id", "task", "place", "n", "ids"],
            )
        # Workers outlive a task: keep the words of late, give back the rest.
        words.old = {}
        pa.default_memory_pool().release_unused()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, task int, place long, n long, ids binary"
    )


def cut(placed: DataFrame, length: int = LENGTH) -> DataFrame:
    """The pieces of rows (doc_id, at, n, ids) whose global place is ``at``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column("at").to_numpy()
            n = batch.column("n").to_numpy()
            pieces = (at + n - 1) // length - at // length + 1
            row = np.repeat(np.arange(len(n)), pieces)
            nth = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            sequence = at[row] // length + nth
            begin = np.maximum(at[row], sequence * length)
            end = np.minimum((at + n)[row], (sequence + 1) * length)
            start = begin - at[row]
            sums, blobs = [], batch.column("ids")
            for r, a, size in zip(row.tolist(), start.tolist(), (end - begin).tolist()):
                blob = memoryview(blobs[r].as_buffer())
                width = len(blob) // int(n[r])
                part = blob[a * width : (a + size) * width]
                sums.append(zlib.crc32(np.frombuffer(part, f"<u{width}").astype("<u4").tobytes()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(row)), pa.array(start, pa.int64()),
                    pa.array(end - begin, pa.int64()), pa.array(sums, pa.int64()), pa.array(n[row], pa.int64()),
                    pa.array(sequence, pa.int64()), pa.array(begin - sequence * length, pa.int64()),
                    pa.array(begin > at[row]), pa.array(end < (at + n)[row]),
                ],
                names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                       "continued", "continues"],
            )

    return placed.select("doc_id", "at", "n", "ids").mapInArrow(
        run,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
        "continued boolean, continues boolean",
    )


def pack(docs: DataFrame, path: str, length: int = LENGTH, end_id: int = END_ID) -> DataFrame:
    """One row per piece of a document in a sequence of ``length`` tokens.

    A null or empty text is the end id alone. Rows that repeat a doc_id, or have none, are packed each. A long
    document fills several sequences. An empty table gives no rows. Columns other than doc_id and text are
    ignored; ``continued`` and ``continues`` mark the boundary records.
    """
    rows = saved(tokenise(docs, path, end_id), "token-ids")
    totals = rows.groupBy("task").agg(F.sum("n").alias("total"))
    upto = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    base = saved(totals.select("task", F.coalesce(F.sum("total").over(upto), F.lit(0)).alias("base")), "offsets")
    placed = rows.join(small_or_shuffled(base, BROADCAST_TASKS), "task").withColumn(
        "at", F.col("base") + F.col("place")
    )
    return cut(placed, length)
