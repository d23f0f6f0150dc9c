"""Token counts by a compiled transducer: how many pieces a BPE model makes of a text, without making them.

The model merges the best-ranked pair first. That has an equivalent from left to right: the pieces of a prefix end in the
one piece that (a) is a suffix of the prefix and (b) stays apart from the last piece before it when the two are encoded by
themselves. So a state needs only those suffixes that may still grow into a piece, each with the piece before it and the
difference in count; reading a character leads to one next state and emits the change of the count. States and
transitions are compiled when they are first met and then looked up.

Where no piece can reach across, between words and around characters that have no piece, the transducer is back at its
start. A chunk of a text therefore maps any entry state to an exit state by three parts: what is before its first such
cut, the count between, what is behind its last one. These maps are associative, so the chunks of a long text are mapped
one by one and composed pairwise, like in a parallel prefix scan.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwatch.llm import wordhash

LIMIT = 4096
CHUNK = 1 << 16
#: Compiled states, and remembered words, that a worker keeps before it starts anew.
MAX_STATES = 300_000
MAX_WORDS = 500_000

SPACE = "▁"  # how the model writes a space
_RUNS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Transducer:
    """Counts the pieces of a string that holds the model's own spaces and starts behind a cut."""

    def __init__(self, ranks: dict[str, float]) -> None:
        self.ranks = ranks
        self.prefixes = {p[:i] for p in ranks for i in range(1, len(p))}
        self.apart: dict[tuple, bool] = {}
        self.reset()

    def reset(self) -> None:
        self.start = (("", None, 0),)
        self.names = {self.start: 0}
        self.states = [self.start]
        self.moves: list[dict[str, tuple[int, int]]] = [{}]

    def pieces(self, text: str) -> list[str]:
        """The definition, for short strings: merge the best pair, the leftmost of equals, until none is left."""
        parts = list(text)
        while True:
            pairs = [(self.ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.ranks]
            if not pairs:
                return parts
            _, i = min(pairs)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _fits(self, before: str | None, piece: str) -> bool:
        key = (before, piece)
        found = self.apart.get(key)
        if found is None:
            own = [piece] if before is None else [before, piece]
            if len(self.apart) > MAX_STATES:
                self.apart.clear()
            found = self.apart[key] = self.pieces("".join(own)) == own
        return found

    def _move(self, state: int, c: str) -> tuple[int, int]:
        live = self.states[state]
        for suffix, before, ahead in live:
            piece = suffix + c
            if piece in self.ranks and self._fits(before, piece):
                change = ahead + 1
                grown = [(s + c, b, n - change) for s, b, n in live if s + c in self.prefixes]
                after = (*grown, ("", piece, 0))
                break
        else:
            change, after = len(c.encode()), self.start  # no piece: as many byte pieces as the character has bytes
        to = self.names.get(after)
        if to is None:
            to = self.names[after] = len(self.states)
            self.states.append(after)
            self.moves.append({})
        self.moves[state][c] = (to, change)
        return to, change

    def count(self, text: str) -> int:
        if len(self.states) > MAX_STATES:
            self.reset()
        state, n, moves = 0, 0, self.moves
        for c in text:
            step = moves[state].get(c) or self._move(state, c)
            state = step[0]
            n += step[1]
        return n


class _Remembered(dict):
    """Counts of words that follow ``lead``."""

    def __init__(self, transducer: Transducer, lead: str) -> None:
        self.transducer, self.lead = transducer, lead

    def __missing__(self, word: str) -> int:
        if len(self) >= MAX_WORDS:
            self.clear()
        n = self[word] = self.transducer.count(self.lead + word)
        return n


@dataclass
class ChunkMap:
    """Of a chunk: the part before its first cut, the count between, the part from its last cut on.

    Without a cut all of it is ``head``, and ``tail`` is None.
    """

    head: str
    count: int
    tail: str | None


class Counter:
    """Piece counts of whole texts for one model."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        usual = [
            i for i in range(model.vocab_size())
            if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))
        ]
        ranks = {model.id_to_piece(i): -model.get_score(i) for i in usual}
        if any(SPACE in p.lstrip(SPACE) for p in ranks) or any("\n" in p for p in ranks):
            raise ValueError("pieces of this model reach across words or lines")
        self.transducer = Transducer(ranks)
        self.marked = _Remembered(self.transducer, SPACE)
        self.bare = _Remembered(self.transducer, "")

    def fragment(self, text: str) -> int:
        """Of a text that starts behind a cut; nothing is put in front of it."""
        if "  " in text or SPACE in text:
            runs = _RUNS.findall(text.replace(" ", SPACE))
            return sum(map(self.transducer.count, runs))
        lines = text.split("\n")
        n = len(lines) - 1
        for line in lines:
            first, *words = line.split(" ")
            n += self.bare[first] + sum(map(self.marked.__getitem__, words))
        return n

    def chunk(self, text: str) -> ChunkMap:
        """Cuts lie behind a line end and between a space and a character before it that is none."""
        first = next(_cuts(text), None)
        if first is None:
            return ChunkMap(text, 0, None)
        last = _last_cut(text)
        return ChunkMap(text[:first], self.fragment(text[first:last]), text[last:])

    def compose(self, a: ChunkMap, b: ChunkMap) -> ChunkMap:
        if a.tail is None:
            # The border itself may be a cut that neither side sees; the fragment then counts right all the same.
            return ChunkMap(a.head + b.head, b.count, b.tail)
        if b.tail is None:
            return ChunkMap(a.head, a.count, a.tail + b.head)
        return ChunkMap(a.head, a.count + self.fragment(a.tail + b.head) + b.count, b.tail)

    def count(self, text: str, chunk: int = CHUNK) -> int:
        if not text:
            return 0
        text = " " + text  # the model puts a space in front of a text
        if len(text) <= chunk:
            return self.fragment(text)
        maps = [self.chunk(text[i : i + chunk]) for i in range(0, len(text), chunk)]
        while len(maps) > 1:
            maps = [self.compose(*maps[i : i + 2]) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
        return self.fragment(maps[0].head) + maps[0].count + self.fragment(maps[0].tail or "")


_CUT = re.compile(f"(?<=\n)|(?<=[^ {SPACE}])(?= )")


def _cuts(text: str) -> Iterator[int]:
    return (m.start() for m in _CUT.finditer(text) if 0 < m.start() < len(text))


def _last_cut(text: str) -> int:
    """The last cut of a text that has one."""
    for width in (256, 4096, len(text)):
        lo = max(len(text) - width, 0)
        found = [m.start() for m in _CUT.finditer(text, lo) if max(lo, 0) < m.start() < len(text)]
        if found:
            return found[-1]
    raise ValueError("no cut")


_loaded: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _loaded:
        _loaded[path] = Counter(path)
    return _loaded[path]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit.

    A null text counts as empty, which has no tokens; bytes that are no UTF-8 are read as U+FFFD. Repeated rows are counted
    each, an empty table gives no rows, other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(path)
        for batch in batches:
            counts = [own.count(t) for t in wordhash.texts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())],
                names=["doc_id", "n_bytes", "n_tokens"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), "text"
    )
    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long").withColumn(
        "over_limit", F.col("n_tokens") > limit
    )
