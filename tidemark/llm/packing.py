"""Best-fit packing of tokenised documents into sequences, improved by swap-based local search.

Documents become token ids with an end id; only those longer than a sequence are cut. Full
pieces are sequences of their own. The others are dealt at random into groups of bounded
size. A group is packed best-fit, longest first, then improved: underfull sequences, the
emptiest first, move a piece to another one, or exchange one for one, two for one or one for
two, each step raising the sum of squared fills, until no sequence can be emptied any more. Sequences that stay underfull give their pieces to a next round of
fewer groups, so what groups lose at their edges is won back.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import numbered, staged

SEQUENCE_TOKENS = 4096
END_ID = 1
#: Pieces packed together by one task.
GROUP_PIECES = 8192
#: The emptiest sequences that may give a piece away in one step; there are at most as many steps as pieces, so
#: the search's work stays in proportion to a group (all pieces are packed whenever it ends).
GIVERS = 16
#: Sequences with a share free are opened again in the next round: the first share that leaves it half of the pieces at most.
OPEN_SHARES = (0.005, 0.02, 0.05, 0.1, 0.2)
#: Words whose ids a worker remembers, their longest length, and characters and words tokenised at a time.
REMEMBERED, WORD_CHARS, SLICE, WORDS_AT_A_TIME = 300_000, 48, 1 << 20, 1 << 19

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


# --- tokenising -----------------------------------------------------------------------

# In texts of these characters white space always parts tokens, and normalising changes
# nothing but case, so a word's ids don't depend on its neighbours.
_PLAIN = re.compile("[\t\n\r\x20-\x7e¡-įı-ſ]*")
# The tokenizer's own rule for parting words (a fixed value of its file).
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_LOADED: dict[str, tuple] = {}


def _loaded(path: str) -> tuple:
    """Tokenizer, array code of its ids, (tokenizer of single words, which ids end a word), ids of words and of
    strings between white space met so far."""
    if path not in _LOADED:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers

        tokenizer, words = Tokenizer.from_file(path), Tokenizer.from_file(path)
        # For words that are normalised and parted already.
        words.normalizer = None
        words.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(
            add_prefix_space=False, trim_offsets=True, use_regex=False)])
        size = tokenizer.get_vocab_size()
        ends = np.zeros(size, dtype=bool)
        ends[[i for w, i in tokenizer.get_vocab().items() if w.endswith("</w>")]] = True
        _LOADED[path] = tokenizer, "H" if size <= 1 << 16 else "I", (words, ends), {}
    return _LOADED[path]


def _ids_of_parts(parts: list[str], path: str) -> list[bytes]:
    """Ids of single words, all in one go: they are joined by spaces and parted at the word ends."""
    tokenizer, code, (words, ends), *_ = _loaded(path)
    ids = np.array(words.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, dtype=code)
    cuts = np.flatnonzero(ends[ids]) + 1
    if len(cuts) != len(parts) or (len(ids) and cuts[-1] != len(ids)):
        return [array(code, e.ids).tobytes() for e in tokenizer.encode_batch(parts, add_special_tokens=False)]
    raw, width = ids.tobytes(), ids.itemsize
    edges = [0, *(cuts * width).tolist()]
    return [raw[a:b] for a, b in zip(edges, edges[1:])]


def _remember(memory: dict[str, bytes], new: dict[str, bytes]) -> None:
    """Words met early are the frequent ones: a full memory stays as it is."""
    if len(memory) < REMEMBERED:
        memory.update((w, ids) for w, ids in new.items() if len(w) <= WORD_CHARS)


def _slices(text: str) -> Iterator[str]:
    """A text in parts cut at white space, where no token spans."""
    at = 0
    while at < len(text):
        end = at + SLICE
        while end < len(text) and text[end] not in " \n\t":
            end += 1
        yield text[at:end]
        at = end


def _ids_of_words(words: list[str], path: str) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words, where each word's ids end). Each distinct string is looked up once."""
    _, code, _, memory = _loaded(path)
    codes, distinct = pd.factorize(np.array(words, dtype=object))
    known = list(map(memory.get, distinct))
    new = {w: [w] if w.isalpha() else _PARTS.findall(w) for w, k in zip(distinct, known) if k is None}
    if new:
        parts = list({p for own in new.values() for p in own}.difference(memory))
        met = dict(zip(parts, _ids_of_parts(parts, path))) if parts else {}
        here = {w: b"".join([met[p] if p in met else memory[p] for p in own]) for w, own in new.items()}
        known = [here[w] if k is None else k for w, k in zip(distinct, known)]
        _remember(memory, met)
        _remember(memory, here)
    flat = np.frombuffer(b"".join(known), dtype=code)
    sizes = np.fromiter(map(len, known), np.int64, len(known)) // flat.itemsize
    starts = np.cumsum(sizes) - sizes
    own = sizes[codes]
    ends = np.cumsum(own)
    place = np.repeat(starts[codes] - (ends - own), own) + np.arange(ends[-1] if len(ends) else 0)
    return flat[place], ends


def token_ids(texts: list[str | None], path: str) -> list[np.ndarray]:
    """Ids of whole texts by the tokenizer at ``path``, without special tokens added.

    Words of plain texts are looked up in a bounded memory, many at a time; anything else goes
    to the tokenizer as it is.
    """
    tokenizer, code, *_ = _loaded(path)
    out: list[list[np.ndarray]] = [[] for _ in texts]
    words: list[str] = []
    waiting: list[tuple[int, int, int]] = []  # text, place in its list, words up to here

    def solve() -> None:
        ids, ends = _ids_of_words(words, path)
        first = 0
        for text, place, last in waiting:
            stop = int(ends[last - 1]) if last else 0
            out[text][place] = ids[first:stop]
            first = stop
        words.clear()
        waiting.clear()

    for n, text in enumerate(texts):
        for piece in _slices(text or ""):
            if "<|" in piece or not _PLAIN.fullmatch(piece):
                out[n].append(np.array(tokenizer.encode(piece, add_special_tokens=False).ids, dtype=code))
                continue
            words += piece.lower().split()
            waiting.append((n, len(out[n]), len(words)))
            out[n].append(np.empty(0, dtype=code))
            if len(words) >= WORDS_AT_A_TIME:
                solve()
    solve()
    return [own[0] if len(own) == 1 else np.concatenate(own) if own else np.empty(0, dtype=code) for own in out]


def tokenized_pieces(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                     size: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32)`` for every piece of every row."""
    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            doc, piece, start, length, crc = [], [], [], [], []
            for i, own_ids in zip(pdf["doc_id"].astype("Int64"), token_ids(list(pdf["text"]), path)):
                ids = np.append(own_ids.astype("<u4"), np.uint32(end_id))
                for k in range(0, len(ids), size):
                    own = ids[k:k + size]
                    doc.append(i)
                    piece.append(k // size)
                    start.append(k)
                    length.append(len(own))
                    crc.append(zlib.crc32(own.tobytes()))
            yield pd.DataFrame({"doc_id": pd.array(doc, dtype="Int64"), "piece": piece, "start": start, "length": length, "ids_crc32": crc})
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return own.mapInPandas(cut, PIECES)


# --- packing of one group ----------------------------------------------------------------

@dataclass
class Bin:
    free: int
    items: dict[int, list[int]] = field(default_factory=dict)  # length → pieces

    def put(self, length: int, item: int) -> None:
        self.items.setdefault(length, []).append(item)
        self.free -= length

    def take(self, length: int) -> int:
        item = self.items[length].pop()
        if not self.items[length]:
            del self.items[length]
        self.free += length
        return item


def best_fit(lengths: np.ndarray, size: int) -> list[Bin]:
    """Longest first, each into the fullest bin that has room."""
    bins: list[Bin] = []
    by_free: dict[int, list[int]] = {}
    frees = 0  # bit f is set if some bin has f free
    for item in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[item])
        fits = frees >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            which = by_free[free].pop()
            if not by_free[free]:
                frees ^= 1 << free
        else:
            which = len(bins)
            bins.append(Bin(size))
        b = bins[which]
        b.put(n, item)
        if b.free:
            by_free.setdefault(b.free, []).append(which)
            frees |= 1 << b.free
    return bins


def _options(which: int, b: Bin) -> np.ndarray:
    """Nothing, one length or two that a bin could give: rows of (bin, given, first, second)."""
    own = sorted(b.items)
    rows = [(which, 0, 0, 0), *((which, y, y, 0) for y in own)]
    rows += [(which, y + z, y, z) for i, y in enumerate(own) for z in own[i:] if y != z or len(b.items[y]) > 1]
    return np.array(rows, dtype=np.int64)


def _best_step(bins: list[Bin], giver: int, options: np.ndarray, size: int) -> tuple[int, tuple[int, ...]] | None:
    """The exchange that raises the sum of squared fills most: (row of options, lengths given for it)."""
    which, given, first, second = options.T
    frees = np.array([b.free for b in bins])[which]
    fill, items = size - bins[giver].free, bins[giver].items
    own = sorted(items, reverse=True)
    pairs = [(x, y) for i, x in enumerate(own) for y in own[i:] if x != y or len(items[x]) > 1]
    best: tuple[int, int, tuple[int, ...]] | None = None
    for gives in [(x,) for x in own] + pairs:
        more = sum(gives) - given  # what the other bin gains
        fits = (more > 0) & (more <= frees) & (which != giver)
        if len(gives) == 2:
            fits &= (second == 0) & (first > 0)  # two for one
        # The sum of squares rises by 2 * more * (other's fill - own fill + more).
        gain = np.where(fits, more * (size - frees - fill + more), 0)
        k = int(gain.argmax())
        if gain[k] > 0 and (best is None or gain[k] > best[0]):
            best = int(gain[k]), k, gives
    return best and best[1:]


def local_search(bins: list[Bin], size: int) -> list[Bin]:
    """Exchange pieces between underfull bins until no exchange from one of the emptiest raises the sum of
    squared fills, or until the others haven't the room for the emptiest bin's pieces, so no bin can be
    emptied any more."""
    full, under = [b for b in bins if not b.free], [b for b in bins if b.free]
    steps = sum(len(items) for b in under for items in b.items.values())

    def can_empty() -> bool:
        own = [b for b in under if b.items]
        emptiest = max((b.free for b in own), default=0)
        return len(own) > 1 and sum(b.free for b in own) - emptiest >= size - emptiest

    options = [_options(k, b) for k, b in enumerate(under)] if can_empty() else []
    while steps and can_empty():
        step, steps = None, steps - 1
        all_options = np.concatenate([o for o, b in zip(options, under) if b.items and b.free])
        for giver in heapq.nlargest(GIVERS, (k for k, b in enumerate(under) if b.items and b.free), key=lambda k: under[k].free):
            if step := _best_step(under, giver, all_options, size):
                break
        if not step:
            break
        row, gives = step
        k, _, *back = all_options[row].tolist()
        there = [(x, under[giver].take(x)) for x in gives]
        here = [(y, under[k].take(y)) for y in back if y]
        for x, item in there:
            under[k].put(x, item)
        for y, item in here:
            under[giver].put(y, item)
        for changed in (giver, k):
            options[changed] = _options(changed, under[changed])
    return full + [b for b in under if b.items]


def pack_lengths(lengths: np.ndarray, size: int = SEQUENCE_TOKENS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bin, offset, the bin's free tokens) of each piece."""
    which, offset, free = (np.zeros(len(lengths), dtype=np.int64) for _ in range(3))
    for k, b in enumerate(local_search(best_fit(lengths, size), size)):
        at = 0
        for n in sorted(b.items, reverse=True):
            for item in b.items[n]:
                which[item], offset[item], free[item] = k, at, b.free
                at += n
    return which, offset, free


# --- operator -------------------------------------------------------------------------

def _packer(base: int, size: int):
    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("__row", ignore_index=True)
        which, offset, free = pack_lengths(pdf["length"].to_numpy(), size)
        first = base + (int(pdf["__group"].iloc[0]) << 20)
        return pdf.drop(columns="__group").assign(sequence_id=first + which, offset=offset, free=free)
    return pack


def pack_pieces(pieces: DataFrame, size: int = SEQUENCE_TOKENS) -> DataFrame:
    """``pieces`` (written, with ``length``) with ``sequence_id`` and ``offset``."""
    columns = pieces.columns
    rows = staged(numbered(pieces, "__row"), "pieces")
    done = rows.where(F.col("length") >= size).select(
        *columns, (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    left = rows.where(F.col("length") < size)
    count, this_round = left.count(), 0
    while count:
        groups = -(-count // GROUP_PIECES)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
        group = F.when(F.lit(groups == 1), F.lit(0)).otherwise(
            F.pmod(F.xxhash64("__row", F.lit(this_round)), F.lit(groups))).cast("long")
        # A hash deals unevenly, but by little: a group is a few per cent off GROUP_PIECES.
        packed = staged(left.withColumn("__group", group).groupBy("__group").applyInPandas(
            _packer(this_round << 52, size), f"{fields}, sequence_id long, offset long, free long"), "packed")
        still, is_open = 0, F.lit(False)
        if groups > 1:  # open the emptiest sequences, holding half of the pieces at most, again
            limits = [max(1, int(size * share)) for share in OPEN_SHARES]
            held = packed.agg(*[F.count_if(F.col("free") >= limit) for limit in limits]).first()
            still, is_open = next(((n, F.col("free") >= limit) for n, limit in zip(held, limits) if n <= count // 2), (0, is_open))
        done = done.unionByName(packed.where(~is_open).select(*columns, "sequence_id", "offset"))
        left, count, this_round = packed.where(is_open).select(*rows.columns), still, this_round + 1
    return done


def pack_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
                   size: int = SEQUENCE_TOKENS, end_id: int = END_ID) -> DataFrame:
    """``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``: a row for every piece of every row.

    Null and empty texts are one piece of the end id alone. Rows with equal or null ids are packed
    each by itself. Texts of any length are cut into pieces of ``size``. An empty table gives no
    rows. Other columns of ``docs`` are not looked at.
    """
    return pack_pieces(tokenized_pieces(docs, path, id_col, text_col, size, end_id), size)
