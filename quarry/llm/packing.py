"""Vector bin packing of examples into fixed-length training sequences.

Every sequence obeys three limits at once: tokens, segments (pieces of examples) and loss-bearing tokens. The open
sequence takes, of the examples that still fit it in all three, the one whose demand vector has the largest dot
product with the sequence's free capacity (both as shares of the limits); when none fits, the largest example left is
cut so that its head fills what is free and its tail goes back to the pool.

Packing is local: a task packs its rows in blocks of ``block`` examples, so nothing is shuffled, a task holds the ids
of one block, and at most the last sequence of a block is left short of examples. Sequence numbers carry the number of
the Spark partition, so they are unique, and a repeated task numbers them the same way again.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from quarry.llm.common import give_back, kept, only, tidy
from quarry.llm.pieces import SPLIT, Table, offsets

PIECES = ("id long, start long, length long, ids binary, total long, sequence_id long, offset long, "
          "segment int, loss long")
_ARROW = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()),
                    ("total", pa.int64()), ("sequence_id", pa.int64()), ("offset", pa.int64()),
                    ("segment", pa.int32()), ("loss", pa.int64())])
END = 0                      # the id that closes an example
# Fixed value: the words of byte-level pre-tokenisation.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LONG = 1 << 10               # bytes of a chunk that is encoded alone
ENTRIES = 250_000            # chunks of text in a generation of those whose ids a task remembers
TOGETHER = 2_000             # new chunks encoded as one string
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most."""
    tokens: int = 1024
    segments: int = 128
    loss: int = 1024


def same_ranks(tok):
    """A ``tiktoken`` encoding with the ids of ``tok``, which is several times faster on new words; None unless ``tok`` is
    a plain byte-level BPE whose ids are in the order of its merges, so that both merge alike."""
    import tiktoken

    d = json.loads(tok.to_str())
    model, before = d["model"], d["pre_tokenizer"] or {}
    if (model["type"], before.get("type"), d["normalizer"]) != ("BPE", "ByteLevel", None):
        return None
    if before.get("add_prefix_space") or not before.get("use_regex") or model.get("dropout") or model.get("ignore_merges") \
            or model.get("continuing_subword_prefix") or model.get("end_of_word_suffix"):
        return None
    # bytes that print stand for themselves, the others for the characters from 256 on
    shown = [b for b in range(256) if 33 <= b <= 126 or b >= 161 and b != 173]
    back = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    merges = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [model["vocab"][m] for m in merges]
    if ids != sorted(ids) or any(model["vocab"].get(c, 1 << 30) >= min(ids, default=0) for c in back):
        return None
    ranks = {bytes(back[c] for c in t): i for t, i in model["vocab"].items()}
    return tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})


class Encoder:
    """Ids of whole texts by a byte-level BPE tokenizer of the ``tokenizers`` library.

    The tokenizer's own pre-tokenisation always starts a new word at a space that stands between two other
    characters, so a text can be cut there and the ids of its chunks joined. A block of texts becomes codes of its
    distinct chunks; a task keeps the ids of chunks it met, in two generations, and encodes new ones many at a time,
    telling them apart by the byte lengths of the ids. Special tokens' strings are special tokens, as in a plain call.
    """

    def __init__(self, path: str, entries: int = ENTRIES):
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        n = self.tok.get_vocab_size()
        # a byte-level token is written with one character for each byte, a special one as it is
        self.width = np.array([len(self.tok.id_to_token(i) or "") for i in range(n)], np.int64)
        self.special = [t.content.encode() for t in self.tok.get_added_tokens_decoder().values()]
        self.fast = same_ranks(self.tok)
        self.known = Table(self._learn, entries, TOGETHER)

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of a space and each chunk, by the faster library where it gives the same."""
        if self.fast is None:
            return self._together(chunks, self.tok_ids)
        plain = [c for c in chunks if len(c) <= LONG and not any(x in c for x in self.special)]
        found = dict(zip(plain, self._together(plain, self.fast.encode_ordinary)))
        for c in chunks:
            if c not in found:
                found[c] = self._together([c], self.tok_ids)[0]
        return [found[c] for c in chunks]

    def tok_ids(self, text: str) -> list[int]:
        return self.tok.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _together(self, chunks: list[bytes], encode: Callable[[str], list[int]]) -> list[bytes]:
        """Chunks encoded as one text and told apart by the byte lengths of the ids."""
        if not chunks:
            return []
        ids = np.array(encode((b" " + b" ".join(chunks)).decode()), "<u4")
        at = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum([len(c) + 1 for c in chunks])) + 1
        raw, at = ids.tobytes(), (np.concatenate([[0], at]) * 4).tolist()
        return [raw[i:j] for i, j in zip(at, at[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        # spaces beside spaces belong together: cut only between other characters
        marked = [SPLIT.join([p.encode() for p in _BETWEEN.split(t)]) if "  " in t or t[:1] == " " or t[-1:] == " " else
                  t.encode().replace(b" ", SPLIT) for t in texts]
        parts = pc.split_pattern(pa.array(marked, pa.large_binary()), SPLIT)
        flat, ends = parts.flatten(), np.cumsum(pc.list_value_length(parts).to_numpy())
        first = np.zeros(len(flat), bool)
        first[np.append(0, ends[:-1])] = True
        heads = [e.ids for e in self.tok.encode_batch_fast(flat.filter(pa.array(first)).cast(pa.large_string()).to_pylist(),
                                                           add_special_tokens=False)]
        table = flat.filter(pa.array(~first)).dictionary_encode()
        found = pa.array(self.known.of(table.dictionary.to_pylist()), pa.large_binary()).take(table.indices)
        place = offsets(found)[np.append(0, ends - np.arange(1, len(ends) + 1))].tolist()
        raw = found.buffers()[2]
        raw = raw.to_pybytes() if raw else b""
        return [np.array(h, "<u4").tobytes() + raw[a:b] for h, a, b in zip(heads, place, place[1:])]


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; workers outlive tasks, so it is loaded once, and goes when the worker
    gets other work."""
    held = kept(__name__)
    if path not in held:
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        held[path] = Encoder(path)
        give_back()                                               # what loading it took
    return held[path]


def cut(total: int, prompt: int, limits: Limits) -> list[tuple[int, int]]:
    """``(start, length)`` of an example cut into the longest pieces a sequence can hold. Ids from ``prompt`` on
    bear loss."""
    pieces, at = [], 0
    while at < total:
        end = min(total, at + limits.tokens, max(at, prompt) + limits.loss)
        pieces.append((at, end - at))
        at = end
    return pieces


def pack(length: np.ndarray, prompt: np.ndarray, limits: Limits) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(item, start in item, length)``. ``length``: ids of each item, at most a sequence; ``prompt``:
    how many of its first ids bear no loss."""
    cap = np.array([limits.tokens, limits.segments, limits.loss], float)
    left, free = length.astype(np.int64).copy(), np.minimum(prompt, length).astype(np.int64)
    begin = np.zeros(len(left), np.int64)
    loss = left - free
    alive = np.argsort(-left, kind="stable")
    alive = alive[left[alive] > 0]
    bins = []
    while len(alive):
        room, here = cap.copy(), []
        while len(alive) and room[0] > 0 and room[1] > 0:
            x, y = left[alive], loss[alive]
            fits = (x <= room[0]) & (y <= room[2])
            if fits.any():
                score = x * (room[0] / cap[0] ** 2) + y * (room[2] / cap[2] ** 2) + room[1] / cap[1] ** 2
                k = int(np.argmax(np.where(fits, score, -1.0)))
                i = int(alive[k])
                take = int(left[i])
                alive = np.delete(alive, k)
            else:
                i = int(alive[int(np.argmax(x))])
                take = int(min(room[0], left[i], free[i] + room[2]))
                if take <= 0:
                    break
            here.append((i, int(begin[i]), take))
            paid = max(0, take - int(free[i]))
            room -= (take, 1, paid)
            begin[i] += take
            left[i] -= take
            free[i] = max(0, int(free[i]) - take)
            loss[i] -= paid
        bins.append(here)
    return bins


def pack_examples(df: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", prompt: str | None = None,
                  limits: Limits = Limits(), block: int = 4096) -> DataFrame:
    """Pack every row of ``df`` and return one row per piece (``PIECES``): the example's id, how many of its ids
    come before the piece, the piece's ids (little-endian 32-bit), the example's number of ids, the sequence, the
    place in it, the segment's number there, and how many of the piece's ids bear loss.

    An example is ``prompt`` (without loss) then ``text`` then the id ``END``; without ``prompt`` all ids bear
    loss. A null text or prompt is empty, so such a row still gives ``END``. A null id stays null; repeated rows and
    ids are packed one by one. Texts of any length are encoded whole and cut. An empty table gives no pieces. Other
    columns of ``df`` are not read.
    """
    if min(limits.tokens, limits.segments, limits.loss) < 1:
        raise ValueError("limits must be at least 1")
    src = only(df, id=id, text=text, **({"prompt": prompt} if prompt else {}))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        end = np.array([END], "<u4").tobytes()
        sequence = TaskContext.get().partitionId() << 40
        rest: list[tuple] = []       # pieces that share a sequence with others: id, start, ids, total, prompt left
        seen = 0

        def flush() -> Iterator[tuple]:
            nonlocal sequence
            for here in pack(np.array([len(r[2]) // 4 for r in rest]), np.array([r[4] for r in rest]), limits):
                offset = 0
                for k, (i, at, n) in enumerate(here):
                    doc, start, ids, total, free = rest[i]
                    yield (doc, start + at, n, ids[at * 4:(at + n) * 4], total, sequence, offset, k,
                           max(0, n - max(0, free - at)))
                    offset += n
                sequence += 1
            rest.clear()

        def rows(docs: list, heads: list[bytes], bodies: list[bytes]) -> Iterator[tuple]:
            nonlocal sequence, seen
            for doc, head, body in zip(docs, heads, bodies):
                ids = head + body + end
                total, free = len(ids) // 4, len(head) // 4
                for start, n in cut(total, free, limits):
                    here = max(0, free - start)
                    paid = max(0, n - here)
                    piece = ids[start * 4:(start + n) * 4]
                    if n == limits.tokens:
                        yield doc, start, n, piece, total, sequence, 0, 0, paid
                        sequence += 1
                    else:
                        rest.append((doc, start, piece, total, here))
                seen += 1
                if seen % block == 0:
                    yield from flush()

        def batch(found: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), _ARROW)],
                                              schema=_ARROW)

        found, size = [], 0
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                texts = [t or "" for t in part.column("text").to_pylist()]
                heads = ([b""] * len(texts) if prompt is None else
                         enc.encode([t or "" for t in part.column("prompt").to_pylist()]))
                for r in rows(part.column("id").to_pylist(), heads, enc.encode(texts)):
                    found.append(r)
                    size += len(r[3]) + 64
                    if size > 4 << 20:
                        yield batch(found)
                        found, size = [], 0
        found.extend(flush())
        enc.known.clear()            # the worker lives on, and other work needs the memory
        if found:
            yield batch(found)

    return src.mapInArrow(tidy(run), PIECES)
