"""SentencePiece encoding and decoding through tables of distinct chunks.

A model whose pieces hold the whitespace marker only in front never joins what stands before a marker to what stands
after it. So a text falls into chunks (a run of markers and the word behind it) that are segmented independently. A
block of texts becomes a column of chunks, written as codes into a table of the distinct ones; each distinct chunk is
segmented once by the library, and the ids are joined back by position. Decoding works the same way: ids fall into runs
that begin with a marked piece, and each distinct run is decoded once.

A task keeps what it has segmented between blocks in two generations, so it stays bounded while what is met again
and again is not segmented twice: an entry that was not met in a whole generation is forgotten, nothing else. With the
task the tables end, as workers outlive their tasks and would hold them while other work runs. Nothing is shuffled: one table for the whole corpus would have to be joined to every block that holds a word, which moves the
texts and a row for each block and distinct word; segmenting a word once more in another task costs less.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from quarry.llm.common import only, tidy

MARK = "▁".encode()
ENTRIES = 250_000            # of a generation
LONG = 1 << 10               # longer chunks are not kept
TOGETHER = 500               # chunks that the library gets in one call
BLOCK = 4 << 20              # bytes of text at a time
SPLIT = b"\xff"              # in no valid text
_CUT = re.compile(rb"(?<=[^ ]) ")


class Table:
    """What was made for each key, in two generations. ``learn`` gives the values for a list of new keys."""

    def __init__(self, learn: Callable[[list], list], entries: int = ENTRIES, together: int = TOGETHER):
        self.learn, self.entries, self.together, self.made = learn, entries, together, 0
        self.young: dict = {}
        self.old: dict = {}

    def clear(self) -> None:
        self.young, self.old = {}, {}

    def of(self, keys: list) -> list:
        """The values of distinct keys; those that are not known yet are learnt."""
        if len(self.young) > self.entries:
            self.young, self.old = {}, self.young
        found = list(map(self.young.get, keys))
        new = []
        for i in [i for i, v in enumerate(found) if v is None]:
            v = found[i] = self.old.get(keys[i])
            if v is None:
                new.append(i)
            else:
                self.young[keys[i]] = v
        for at in range(0, len(new), self.together):
            part = new[at:at + self.together]
            for i, v in zip(part, self.learn([keys[i] for i in part])):
                found[i] = v
                if len(keys[i]) <= LONG:
                    self.young[keys[i]] = v
        self.made += len(new)
        return found


class Pieces:
    """A SentencePiece model whose pieces do not cross whitespace markers."""

    def __init__(self, path: str, entries: int = ENTRIES):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i).encode() for i in range(self.sp.get_piece_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces if p.replace(MARK, b"")):
            raise ValueError(f"pieces of {path} cross whitespace markers")
        probe = " a  ﬁ "
        if self.sp.decode(self.sp.encode(probe)) != probe:
            raise ValueError(f"{path} rewrites texts before it segments them")
        self.first = np.array([p.startswith(MARK) for p in pieces])
        self.mark = self.sp.piece_to_id(MARK.decode())
        # runs with these ids are decoded alone: more than one space in front, a space as a byte, no piece of text
        self.alone = np.array([p.startswith(MARK + MARK) or p == b"<0x20>" or self.sp.is_unknown(i)
                               or self.sp.is_control(i) for i, p in enumerate(pieces)])
        self.ids = Table(self._segment, entries)
        self.texts = Table(self._join, entries)

    def _segment(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of a marker and each chunk, as 32-bit integers. The library puts a marker before every text but an empty
        one, so chunks without spaces can be segmented as one text and told apart by the pieces that begin with it."""
        plain = [c for c in chunks if c and b" " not in c]
        raw = np.array(self.sp.encode(b" ".join(plain)), np.int32)
        at = np.append(np.flatnonzero(self.first[raw]) * 4, len(raw) * 4).tolist()
        raw = raw.tobytes()
        found = {c: raw[i:j] for c, i, j in zip(plain, at, at[1:])}
        for c in chunks:
            if c not in found:
                found[c] = np.array(self.sp.encode(c) if c else [self.mark], np.int32).tobytes()
        return [found[c] for c in chunks]

    def _join(self, runs: list[bytes]) -> list[bytes]:
        """Text of each run of ids, its spaces in front included; the library drops one in front of a text only."""
        joined = np.frombuffer(b"".join(runs), np.int32)
        sizes = np.array([len(r) // 4 for r in runs])
        starts = np.cumsum(sizes) - sizes
        alone = np.logical_or.reduceat(self.alone[joined], starts) | ~self.first[joined[starts]]
        plain = joined[np.repeat(~alone, sizes)].tolist()
        words = iter(self.sp.decode(plain).encode().split(b" ") if plain else [])
        return [self.sp.decode([self.mark, *np.frombuffer(r, np.int32).tolist()]).encode() if x else b" " + next(words)
                for r, x in zip(runs, alone.tolist())]

    def encode(self, texts: list[bytes]) -> pa.ListArray:
        """Ids of each text."""
        marked = []
        for t in texts:
            if SPLIT in t:
                t = t.decode("utf-8", "replace").encode()
            t = t.replace(MARK, b" ")            # the model cannot tell the two apart
            # markers beside markers can share a piece: cut only behind something else
            marked.append(_CUT.sub(SPLIT, t) if b"  " in t or t[:1] == b" " else t.replace(b" ", SPLIT))
        chunks = pc.split_pattern(pa.array([t or None for t in marked], pa.large_binary()), SPLIT)
        table = chunks.flatten().dictionary_encode()
        found = pa.array(self.ids.of(table.dictionary.to_pylist()), pa.large_binary()).take(table.indices)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(chunks).fill_null(0).to_numpy())])
        place = offsets(found)[ends] // 4
        return pa.ListArray.from_arrays(pa.array(place.astype(np.int32)),
                                        pa.array(np.frombuffer(found.buffers()[2] or b"", np.int32)[:place[-1]]))

    def decode(self, lists: pa.ListArray) -> list[str]:
        """Text of each list of ids."""
        ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32)
        ends = np.concatenate([[0], np.cumsum(pc.list_value_length(lists).fill_null(0).to_numpy())]).astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.first)):
            raise ValueError("an id that the model does not have")
        starts = self.first[ids]
        begin = ends[:-1][ends[:-1] < ends[1:]]
        starts[begin] = True                     # a run never spans two lists
        at = np.append(np.flatnonzero(starts), len(ids))
        runs = pa.Array.from_buffers(pa.large_binary(), len(at) - 1,
                                     [None, pa.py_buffer(at * 4), pa.py_buffer(np.ascontiguousarray(ids))])
        table = runs.dictionary_encode()
        found = pa.array(self.texts.of(table.dictionary.to_pylist()), pa.large_binary()).take(table.indices)
        place = offsets(found)[np.searchsorted(at, ends)].tolist()
        raw = found.buffers()[2]
        raw = raw.to_pybytes() if raw else b""
        out = []
        for i, (a, b) in enumerate(zip(place, place[1:])):
            if ends[i] < ends[i + 1] and not self.first[ids[ends[i]]]:   # the library drops nothing in front of it
                out.append(self.sp.decode(ids[ends[i]:ends[i + 1]].tolist()))
            else:
                out.append(raw[a + 1:b].decode())
        return out


def offsets(column: pa.Array) -> np.ndarray:
    return np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1] \
        if len(column) else np.zeros(1, np.int64)


_LOADED: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    """The worker's model; workers outlive tasks, so it is loaded once."""
    if path not in _LOADED:
        _LOADED[path] = Pieces(path)
    return _LOADED[path]


def _ending(run: Callable, path: str) -> Callable:
    """``run`` over batches, which leaves the model's tables empty when it is done."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            loaded(path).ids.clear()
            loaded(path).texts.clear()
    return over


def _blocks(batches: Iterator[pa.RecordBatch], sizes: Callable) -> Iterator[pa.RecordBatch]:
    """Parts of the batches of about ``BLOCK`` bytes; a longer row is a part of its own."""
    for b in batches:
        total = np.cumsum(sizes(b))
        at = 0
        while at < b.num_rows:
            before = int(total[at - 1]) if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + BLOCK, side="right")))
            yield b.slice(at, end - at)
            at = end


def _text_bytes(b: pa.RecordBatch) -> np.ndarray:
    return pc.binary_length(b.column("text")).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _texts(b: pa.RecordBatch) -> list[bytes]:
    return [t or b"" for t in b.column("text").cast(pa.binary()).to_pylist()]


def encode(df: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``df``: ``id`` and ``ids`` (array of int), the ids of the whole text without begin or end
    ids. A null or empty text has none; texts are whole, of any length, also without any whitespace. Repeated rows and
    ids each give a row, an empty table none. Other columns are not read."""
    src = only(df, id=id, text=text)
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, _text_bytes):
            yield pa.RecordBatch.from_arrays([b.column("id"), loaded(model).encode(_texts(b))], names=["id", "ids"])

    return src.mapInArrow(tidy(_ending(run, model)), f"id {kind}, ids array<int>")


def decode(df: DataFrame, model: str, id: str = "id", ids: str = "ids") -> DataFrame:
    """One row per row of ``df``: ``id`` and ``text``, as the library decodes the ids. Null or no ids give an empty
    text; a null among the ids is an error. Repeated rows each give a row, an empty table none. Other columns are not
    read."""
    src = only(df, id=id, ids=ids)
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, lambda b: 4 * pc.list_value_length(b.column("ids")).fill_null(0).to_numpy()):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(loaded(model).decode(b.column("ids")), pa.string())],
                                             names=["id", "text"])

    return src.mapInArrow(tidy(_ending(run, model)), f"id {kind}, text string")


def round_trip(df: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``id``, ``ids`` and ``decoded`` (what the ids decode to) for every row of ``df``: ``encode`` and ``decode`` in
    one pass, with the same results for odd rows."""
    src = only(df, id=id, text=text)
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _blocks(batches, _text_bytes):
            ids = loaded(model).encode(_texts(b))
            yield pa.RecordBatch.from_arrays([b.column("id"), ids, pa.array(loaded(model).decode(ids), pa.string())],
                                             names=["id", "ids", "decoded"])

    return src.mapInArrow(tidy(_ending(run, model)), f"id {kind}, ids array<int>, decoded string")
