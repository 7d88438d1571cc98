"""Fill-in-the-middle documents over seekable compressed frames.

A text is stored as independent zstandard frames of bounded size, each with the units, code
points and bytes before it. A unit is a run of the letters A to Z of either case, or any other
code point. A cut at a unit is found by the frames' counts, and only its frame is
decompressed; the frames between cuts go into the output as they are, so reordering a text
copies compressed bytes. Digests and restored texts are streamed, one frame at a time.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.storage import staged

#: Bytes of text in a frame; one ends with a whole code point.
FRAME_BYTES = 1 << 16
#: Percent of the texts that are cut at all, and of those in suffix-prefix-middle order.
CUT_PERCENT, SPM_PERCENT = 90, 20
PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: The markers of a form in the order of its output; the middle always comes last.
FORMS = {"psm": (PREFIX, SUFFIX, MIDDLE), "spm": (SUFFIX, PREFIX, MIDDLE)}

_LETTERS = bytes(range(ord("A"), ord("Z") + 1)) + bytes(range(ord("a"), ord("z") + 1))
_KIND = bytes(ord("a") if b in _LETTERS else ord(".") for b in range(256))
_INNER = bytes(range(0x80, 0xC0))  # bytes of a code point after its first
_IS_LETTER = np.isin(np.arange(256), list(_LETTERS))
_IS_FIRST = (np.arange(256) & 0xC0) != 0x80

_FRAME = pa.struct([("units", pa.int64()), ("chars", pa.int64()), ("bytes", pa.int64()), ("inside", pa.bool_()), ("data", pa.binary())])
STORE = ("doc_id {id}, units long, chars long, marked boolean, "
         "frames array<struct<units: long, chars: long, bytes: long, inside: boolean, data: binary>>")
OUTPUT = "doc_id {id}, n long, form string, prefix_chars long, middle_chars long, frames array<binary>"
DIGESTS = "doc_id {id}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string"


# --- frames ---------------------------------------------------------------------------

def compressed(data: bytes) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(data)


def decompressed(frame: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(frame)


def counted(data: bytes, inside: bool) -> tuple[int, int]:
    """(units that begin in ``data``, code points); ``inside``: a run of letters goes on at its start."""
    kinds = data.translate(_KIND, _INNER)
    return kinds.count(b".") + kinds.count(b".a") + (kinds[:1] == b"a" and not inside), len(kinds)


def frames_of(data: bytes, size: int = FRAME_BYTES) -> tuple[list[dict], int, int]:
    """(frames, units, code points) of a text. A frame ends between code points, maybe within a run of letters."""
    frames, at, units, chars, inside = [], 0, 0, 0, False
    while at < len(data):
        end = min(at + size, len(data))
        while end < len(data) and data[end] & 0xC0 == 0x80:
            end += 1
        piece = data[at:end]
        frames.append({"units": units, "chars": chars, "bytes": at, "inside": inside, "data": compressed(piece)})
        own_units, own_chars = counted(piece, inside)
        units, chars, at, inside = units + own_units, chars + own_chars, end, piece[-1] in _LETTERS
    return frames, units, chars


class Cut:
    """Where a unit begins: its frame, the byte within it and the code points before; the frame's bytes are kept."""

    def __init__(self, frames: list[dict], units: int, chars: int, unit: int):
        self.frame, self.byte, self.chars, self.data = 0, 0, 0, b""
        if unit >= units:
            self.frame, self.chars = len(frames), chars
        if unit in (0, units):  # at either end, where no frame is cut
            return
        self.frame = bisect_right(frames, unit, key=lambda f: f["units"]) - 1
        frame = frames[self.frame]
        self.data = decompressed(frame["data"])
        codes = np.frombuffer(self.data, dtype=np.uint8)
        letter, first = _IS_LETTER[codes], _IS_FIRST[codes]
        before = np.empty_like(letter)
        before[0], before[1:] = frame["inside"], letter[:-1]
        self.byte = int(np.flatnonzero(first & ~(letter & before))[unit - frame["units"]])
        self.chars = frame["chars"] + int(first[:self.byte].sum())


def between(frames: list[dict], a: Cut, b: Cut) -> list[bytes]:
    """The frames of the text from one cut to another; only the cut frames are made anew."""
    if a.frame == b.frame:
        return [compressed(b.data[a.byte:b.byte])] if b.byte > a.byte else []
    out = [compressed(a.data[a.byte:]) if a.byte else frames[a.frame]["data"]]
    out += [f["data"] for f in frames[a.frame + 1:b.frame]]
    return out + ([compressed(b.data[:b.byte])] if b.byte else [])


def streamed(frames: list[bytes], spans: list[tuple[int, int | None]]) -> Iterator[bytes]:
    """The bytes of the given spans of the frames' text, span by span, one frame at a time."""
    sizes = [zstandard.frame_content_size(f) for f in frames]
    for low, high in spans:
        at = 0
        for frame, size in zip(frames, sizes):
            if at + size > low and (high is None or at < high):
                yield decompressed(frame)[max(0, low - at):None if high is None else high - at]
            at += size


def marks(frames: list[bytes], wanted: tuple[bytes, ...]) -> list[int]:
    """Byte offsets of the markers, which come one after the other; raises where one is missing."""
    found, at, rest = [], 0, b""
    for frame in frames:
        piece = rest + decompressed(frame)
        place = 0
        while len(found) < len(wanted) and (place := piece.find(wanted[len(found)], place)) >= 0:
            found.append(at + place)
            place += len(PREFIX)
        kept = min(len(PREFIX) - 1, len(piece) - (found[-1] + len(PREFIX) - at if found and found[-1] >= at else 0))
        at, rest = at + len(piece) - kept, piece[len(piece) - kept:]
    if len(found) < len(wanted):
        raise ValueError(f"an output lacks its marker {wanted[len(found)].decode()}")
    return found


def restored(frames: list[bytes], form: str) -> Iterator[bytes]:
    """The text, rebuilt from an output's frames and form."""
    if form == "plain":
        yield from streamed(frames, [(0, None)])
        return
    order, places = FORMS[form], marks(frames, FORMS[form])
    ends = [*places[1:], None]
    span = {m: (p + len(m), e) for m, p, e in zip(order, places, ends)}
    yield from streamed(frames, [span[PREFIX], span[MIDDLE], span[SUFFIX]])


# --- jobs -----------------------------------------------------------------------------

def _id_type(df: DataFrame, id_col: str) -> str:
    return df.schema[id_col].dataType.simpleString()


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """A batch's rows as Python values, a few at a time."""
    for k in range(0, batch.num_rows, 256):
        yield from batch.slice(k, 256).to_pylist()


def _batches(rows: Iterator[dict], schema: pa.Schema, size: int = 1 << 23) -> Iterator[pa.RecordBatch]:
    """Rows as batches of bounded bytes (a larger row is a batch by itself)."""
    held, total = [], 0
    for row in rows:
        held.append(row)
        total += 200 + sum(len(f["data"] if isinstance(f, dict) else f) for f in row.get("frames", ()))
        if total >= size:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, total = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def frame_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """The frame store of the texts: a row for each document with its units, code points and frames, written under the
    shared folder. A null text is an empty one, which has no frame; null and repeated ids and repeated rows are kept."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text"))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        for batch in batches:
            schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("units", pa.int64()), ("chars", pa.int64()),
                                ("marked", pa.bool_()), ("frames", pa.list_(_FRAME))])

            def rows(batch: pa.RecordBatch = batch) -> Iterator[dict]:
                for row in _rows(batch):
                    frames, units, chars = frames_of(row["text"], frame_bytes)
                    marked = any(m in row["text"] for m in (PREFIX, SUFFIX, MIDDLE))
                    yield {"doc_id": row["doc_id"], "units": units, "chars": chars, "marked": marked, "frames": frames}
            yield from _batches(rows(), schema)

    return staged(own.mapInArrow(store, STORE.format(id=_id_type(docs, id_col))), "frames")


def fill_in_middle(store: DataFrame, seed: int = 1, cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, frames)``: every document of a frame store, reordered, as the
    frames of its output.

    The first 32 hexadecimal digits of sha256(seed:doc_id), in four numbers, decide: the first two, modulo n + 1, are the
    cuts in units; the third whether the text is cut, the fourth in which order. An output is the plain text where that
    says so, where the text is empty, or where it holds a marker, so outputs can always be read back. Of a null id nothing
    stands after the colon. An empty table gives no rows.
    """
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    draws = F.array(*[F.conv(F.substring(digits, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)])

    def reorder(row: dict) -> dict:
        n, frames, h = row["units"], row["frames"], row["draws"]
        out = {"doc_id": row["doc_id"], "n": n, "form": "plain", "prefix_chars": None, "middle_chars": None}
        if not n or row["marked"] or h[2] % 100 >= cut_percent:
            return out | {"frames": [f["data"] for f in frames]}
        low, high = sorted(x % (n + 1) for x in h[:2])
        start, first, second, end = (Cut(frames, n, row["chars"], unit) for unit in (0, low, high, n))
        parts = {PREFIX: between(frames, start, first), MIDDLE: between(frames, first, second), SUFFIX: between(frames, second, end)}
        form = "spm" if h[3] % 100 < spm_percent else "psm"
        output = [f for mark in FORMS[form] for f in (compressed(mark), *parts[mark])]
        return out | {"form": form, "prefix_chars": first.chars, "middle_chars": second.chars - first.chars, "frames": output}

    def reordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            schema = pa.schema([("doc_id", batch.schema.field("doc_id").type), ("n", pa.int64()), ("form", pa.string()),
                                ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("frames", pa.list_(pa.binary()))])
            yield from _batches(map(reorder, _rows(batch)), schema)

    id_type = _id_type(store, "doc_id")
    return store.withColumn("draws", draws).mapInArrow(reordered, OUTPUT.format(id=id_type))


def digests(outputs: DataFrame) -> DataFrame:
    """Digests of the outputs and of the texts rebuilt from them, streamed frame by frame."""
    def of(pieces: Iterator[bytes]) -> str:
        sha = hashlib.sha256()
        for piece in pieces:
            sha.update(piece)
        return sha.hexdigest()

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row | {"output_sha256": of(streamed(row["frames"], [(0, None)])),
                           "restored_sha256": of(restored(row.pop("frames"), row["form"]))} for row in _rows(batch)]
            schema = pa.schema([*[batch.schema.field(c) for c in batch.schema.names if c != "frames"],
                                ("output_sha256", pa.string()), ("restored_sha256", pa.string())])
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return outputs.mapInArrow(digested, DIGESTS.format(id=_id_type(outputs, "doc_id")))
