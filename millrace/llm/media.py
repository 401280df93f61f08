"""Media columns: baseline JPEG, written and read in numpy.

The writer stores bytes without loss in the format's own unit, the quantised coefficient: 64 bytes are an 8x8 block of a
one-component image. The reader parses markers, Huffman-decodes the first scan of any baseline JPEG of one component or
of luminance and two colours, subsampled or not, and rebuilds the luminance thumbnail from the DC coefficients alone. It decodes in lockstep: all restart intervals of all
images of a batch that share their tables advance by one symbol a step, so the cost of a step is that of a few array
operations, whatever the number of images.
"""

from __future__ import annotations

import hashlib
import math
import struct
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm._common import table

#: Coefficients of a block, and so bytes of payload in it.
BLOCK = 64
#: Blocks in a row at most: 65,535 samples, rounded down to whole blocks.
MAX_ACROSS = 8191
#: Bytes of payload that are encoded, or of media that are decoded, at a time.
CHUNK_BYTES = 4 << 20
#: Blocks whose bits are spread out at a time.
BLOCKS_AT_ONCE = 1 << 15


def padded(data: bytes) -> bytes:
    """data with bytes 0 up to a positive multiple of 64."""
    return data.ljust(max(1, -(-len(data) // BLOCK)) * BLOCK, b"\0")


def _segment(marker: int, body: bytes) -> bytes:
    return struct.pack(">BBH", 0xFF, marker, len(body) + 2) + body


def _coded(values: np.ndarray) -> bytes:
    """The scan's bytes of some blocks, a restart marker after each."""
    bits = np.zeros((len(values), BLOCK, 9), np.uint8)
    bits[:, :, 1:] = np.unpackbits(values, axis=1).reshape(len(values), BLOCK, 8)
    coded = np.empty((len(values), 9 * BLOCK // 8 + 2), np.uint8)
    coded[:, :-2] = np.packbits(bits.reshape(len(values), -1), axis=1)
    coded[:, -2], coded[:, -1] = 0xFF, 0xD0 + np.arange(len(values)) % 8
    stuffed = coded == 0xFF
    stuffed[:, -2:] = False
    flat = np.repeat(coded.reshape(-1), 1 + stuffed.reshape(-1))
    at = np.flatnonzero(stuffed.reshape(-1))
    flat[at + np.arange(len(at)) + 1] = 0
    return flat.tobytes()


def encode(payload: bytes) -> bytes:
    """A baseline JPEG whose quantised coefficients are the payload's bytes, a multiple of 64 of them.

    Byte b is the coefficient b - 255 or b, of size category 8, whose amplitude bits are b itself. The one Huffman code,
    a bit 0, stands for category 8 after no zeros. Each block is a restart interval, so that blocks can be decoded side
    by side. Blocks beyond the payload, in the last row, hold bytes 0; a comment tells the payload's length.
    """
    blocks = len(payload) // BLOCK
    down = -(-blocks // MAX_ACROSS)
    across = -(-blocks // down)
    if down > MAX_ACROSS:
        raise ValueError("payload too large for a baseline JPEG")
    values = np.zeros((across * down, BLOCK), np.uint8)
    values.reshape(-1)[: len(payload)] = np.frombuffer(payload, np.uint8)
    # slices of a multiple of 8 blocks, as restart markers repeat every 8
    scan = b"".join(_coded(values[low : low + BLOCKS_AT_ONCE]) for low in range(0, len(values), BLOCKS_AT_ONCE))
    huffman = bytes([1] + [0] * 15) + bytes([8])
    return b"".join(
        (
            b"\xff\xd8",
            _segment(0xE0, b"JFIF\0\x01\x01\0\0\x01\0\x01\0\0"),
            _segment(0xFE, b"payload=%d" % len(payload)),
            _segment(0xDB, b"\0" + b"\x01" * 64),
            _segment(0xC0, struct.pack(">BHHBBBB", 8, down * 8, across * 8, 1, 1, 0x11, 0)),
            _segment(0xC4, b"\0" + huffman + b"\x10" + huffman),
            _segment(0xDD, struct.pack(">H", 1)),
            _segment(0xDA, bytes([1, 1, 0x00, 0, 63, 0])),
            scan[:-2],
            b"\xff\xd9",
        )
    )


@dataclass
class Header:
    """What a scan needs. A unit is what the scan repeats: one block, or the blocks of all components where they are
    interleaved; `parts` has the component of each of its blocks, 0 being luminance. `luma` is how many blocks of
    luminance a unit has across and down, `shape` the rows and columns of luminance blocks within the image."""

    width: int
    height: int
    quant_dc: int
    interval: int
    tables: tuple[tuple[bytes, bytes], ...]
    comment: bytes
    scan_at: int
    parts: tuple[int, ...]
    across: int
    down: int
    luma: tuple[int, int]
    shape: tuple[int, int]
    components: int

    @property
    def blocks(self) -> int:
        return self.across * self.down * len(self.parts)

    @property
    def interval_blocks(self) -> int:
        return self.interval * len(self.parts)


def _frame(body: bytes) -> tuple[int, int, list[tuple[int, int, int, int]]]:
    """Height, width, and per component its name, sampling across and down, and quantiser."""
    height, width = struct.unpack_from(">HH", body, 1)
    if body[0] != 8 or body[5] not in (1, 3) or len(body) < 6 + 3 * body[5]:
        raise ValueError("not 8-bit samples of one or three components")
    found = [(body[k], body[k + 1] >> 4, body[k + 1] & 15, body[k + 2]) for k in range(6, 6 + 3 * body[5], 3)]
    if not width or not height or any(not 1 <= x <= 4 for c in found for x in c[1:3]):
        raise ValueError("no size or sampling")
    return height, width, found


def parse_header(data: bytes) -> Header:
    """Reads the markers up to the first scan. Raises ValueError for what isn't a baseline JPEG with a luminance
    component: alone, interleaved with two others, or first in a scan of its own."""
    if data[:2] != b"\xff\xd8":
        raise ValueError("no start of image")
    at, interval, comment, frame, scan, untransformed = 2, 0, b"", None, None, False
    quant: dict[int, int] = {}
    huffman: dict[int, bytes] = {}
    while scan is None:
        if at + 4 > len(data) or data[at] != 0xFF:
            raise ValueError(f"no marker at byte {at}")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        length = struct.unpack_from(">H", data, at + 2)[0]
        body, at = data[at + 4 : at + 2 + length], at + 2 + length
        if length < 2 or len(body) != length - 2:
            raise ValueError("a cut segment")
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            while body:
                size = 17 + sum(body[1:17])
                huffman[body[0]], body = body[1:size], body[size:]
        elif marker == 0xC0:
            frame = _frame(body)
        elif 0xC1 <= marker <= 0xCF and marker != 0xCC:
            raise ValueError("not baseline")
        elif marker == 0xDD:
            interval = struct.unpack(">H", body[:2])[0]
        elif marker == 0xFE:
            comment = body
        elif marker == 0xEE and body[:5] == b"Adobe":
            untransformed = body[11:12] == b"\0"
        elif marker == 0xDA:
            scan = {body[1 + 2 * k]: body[2 + 2 * k] for k in range(body[0])}
    if frame is None:
        raise ValueError("a frame is missing")
    height, width, components = frame
    if untransformed and len(components) == 3:
        raise ValueError("RGB, which has no luminance")
    names = [c[0] for c in components]
    chosen = [names.index(name) if name in names else -1 for name in scan]
    if sorted(chosen) != list(range(len(names))) and chosen != [0]:
        raise ValueError("the first scan has neither all components nor luminance alone")
    codes = [(x >> 4, 16 + (x & 15)) for x in scan.values()]
    if components[0][3] not in quant or any(dc not in huffman or ac not in huffman for dc, ac in codes):
        raise ValueError("a table is missing")
    tables: list[tuple[bytes, bytes]] = [(b"", b"")] * len(chosen)
    for k, (dc, ac) in zip(chosen, codes):
        tables[k] = huffman[dc], huffman[ac]
    most_h, most_v = max(c[1] for c in components), max(c[2] for c in components)
    _, h, v, q = components[0]
    cols, rows = -(-width * h // (8 * most_h)), -(-height * v // (8 * most_v))
    if len(chosen) == 1:
        parts, luma, across, down = (0,), (1, 1), cols, rows
    else:
        parts = tuple(k for k in chosen for _ in range(components[k][1] * components[k][2]))
        luma, across, down = (h, v), -(-width // (8 * most_h)), -(-height // (8 * most_v))
    header = Header(width, height, quant[q], interval, tuple(tables), comment, at, parts, across, down, luma, (rows, cols), len(components))
    # a block takes two bits at least
    if header.blocks > 4 * (len(data) - at):
        raise ValueError("a cut scan")
    return header


def _lookup(table_: bytes) -> tuple[np.ndarray, np.ndarray]:
    """For each 16 bits the symbol whose code they begin with, and the code's length (0: none)."""
    symbols, lengths = np.zeros(1 << 16, np.int64), np.zeros(1 << 16, np.int64)
    code, k = 0, 16
    for length in range(1, 17):
        for _ in range(table_[length - 1]):
            low, high = code << (16 - length), (code + 1) << (16 - length)
            symbols[low:high], lengths[low:high] = table_[k], length
            code, k = code + 1, k + 1
        code <<= 1
    return symbols, lengths


def _intervals(data: bytes, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The scan's bytes without stuffing and markers, and where its restart intervals begin in them."""
    scan = np.frombuffer(data, np.uint8)[start:]
    at = np.flatnonzero(scan[:-1] == 0xFF)
    after = scan[at + 1]
    restart = (after >= 0xD0) & (after <= 0xD7)
    ends = np.flatnonzero((after != 0) & ~restart & (after != 0xFF))
    end = int(at[ends[0]]) if len(ends) else len(scan)
    at, after, restart = at[at < end], after[at < end], restart[at < end]
    keep = np.ones(end, bool)
    keep[at[after == 0] + 1] = False
    keep[at[restart]] = False
    keep[at[restart] + 1] = False
    markers = at[restart]
    dropped = np.searchsorted(at[after == 0], markers) + 2 * np.arange(len(markers))
    return scan[:end][keep], np.concatenate(([0], markers - dropped))


def decode_many(images: list[tuple[Header, bytes]]) -> list[np.ndarray | None]:
    """The quantised coefficients, in zigzag order, of images that share tables, interval and parts: (blocks, 64) each,
    in the scan's order, or None where the scan is damaged."""
    first = images[0][0]
    # of each component the DC and the AC code
    symbols, lengths = (np.stack(x) for x in zip(*(_lookup(t) for pair in first.tables for t in pair)))
    parts, several = np.array(first.parts), len(first.tables)
    data, begins, blocks, owner, base = [], [], [], [], [0]
    filled = 0
    whole = np.ones(len(images), bool)
    for k, (header, raw) in enumerate(images):
        scan, at = _intervals(raw, header.scan_at)
        each = header.interval_blocks or header.blocks
        whole[k] = len(at) == -(-header.blocks // each)
        at = at[: -(-header.blocks // each)]
        data += [scan]
        begins.append(at + filled)
        filled += len(scan)
        blocks.append(base[-1] + np.arange(len(at)) * each)
        owner.append(np.full(len(at), k))
        base.append(base[-1] + header.blocks)
    stream = np.concatenate([*data, np.zeros(8, np.uint8)])
    window = stream[:-2].astype(np.int32)
    for after in (stream[1:-1], stream[2:]):
        window <<= 8
        window |= after
    bit, block, who = np.concatenate(begins) * 8, np.concatenate(blocks), np.concatenate(owner)
    each = first.interval_blocks
    upto = np.array([base[k + 1] for k in range(len(images))])[who]
    if each:
        upto = np.minimum(upto, block + each)
    bit_end = filled * 8
    out = np.zeros((base[-1], BLOCK), np.int16)
    coefficient, predicted = np.zeros(len(bit), np.int64), np.zeros(len(bit) * several, np.int64)
    live = np.flatnonzero(block < upto)
    while len(live):
        b, k = bit[live], coefficient[live]
        peek = (window[b >> 3] >> (8 - (b & 7))) & 0xFFFF
        kind = (k > 0).astype(np.int64)
        part = parts[block[live] % len(parts)] if several > 1 else 0
        slot = live * several + part
        symbol, length = symbols[2 * part + kind, peek], lengths[2 * part + kind, peek]
        run = np.where(kind == 1, symbol >> 4, 0)
        size = np.where(kind == 1, symbol & 15, np.minimum(symbol, 16))
        b = b + length
        amplitude = ((window[np.minimum(b, bit_end) >> 3] >> (8 - (b & 7))) & 0xFFFF) >> (16 - size)
        value = np.where((size > 0) & (amplitude < (1 << np.maximum(size - 1, 0))), amplitude - (1 << size) + 1, amplitude)
        b = b + size
        stop = (kind == 1) & (size == 0) & (run != 15)
        place = k + run
        bad = (length == 0) | (b > bit_end) | (~stop & (place > 63)) | (size > 15)
        put = ~bad & (size > 0)
        rows = live[put]
        dc = kind[put] == 0
        value = value[put]
        sums = slot[put][dc]
        predicted[sums] += value[dc]
        value[dc] = predicted[sums]
        zero_dc = ~bad & (kind == 0) & (size == 0)
        out[block[live[zero_dc]], 0] = predicted[slot[zero_dc]]
        out[block[rows], place[put]] = value
        k = np.where(stop, 64, place + 1)
        over = k >= 64
        bit[live], coefficient[live] = b, np.where(over, 0, k)
        block[live] += over
        whole[who[live[bad]]] = False
        live = live[~bad & (block[live] < upto[live])]
    return [out[base[k] : base[k + 1]] if whole[k] else None for k in range(len(images))]


def stored_bytes(header: Header, coefficients: np.ndarray) -> bytes:
    """What encode() stored: coefficients back to bytes, the padding blocks dropped."""
    plain = np.where(coefficients < 0, coefficients + 255, coefficients).astype(np.uint8)
    return plain.tobytes()[: int(header.comment.partition(b"=")[2])]


def thumbnail(header: Header, coefficients: np.ndarray) -> np.ndarray:
    """The luminance at an eighth of its size: a sample per block, from its DC coefficient."""
    (h, v), (rows, cols) = header.luma, header.shape
    mine = np.flatnonzero(np.array(header.parts) == 0)
    units = coefficients[:, 0].reshape(header.down, header.across, -1)[:, :, mine]
    grid = units.reshape(header.down, header.across, v, h).transpose(0, 2, 1, 3).reshape(header.down * v, header.across * h)[:rows, :cols]
    return np.clip(np.rint(grid.astype(np.float64) * header.quant_dc / 8 + 128), 0, 255).astype(np.uint8)


def average_hash(thumb: np.ndarray) -> str:
    """64 bits: which of 8x8 cells of the thumbnail are brighter than their mean; 16 hexadecimal digits."""
    ys, xs = (np.minimum((np.arange(8) * n) // 8, n - 1) for n in thumb.shape)
    sums = np.add.reduceat(np.add.reduceat(thumb.astype(np.int64), np.unique(ys), axis=0), np.unique(xs), axis=1)
    count = np.outer(np.diff(np.append(np.unique(ys), thumb.shape[0])), np.diff(np.append(np.unique(xs), thumb.shape[1])))
    cells = (sums / count)[np.ix_(np.searchsorted(np.unique(ys), ys), np.searchsorted(np.unique(xs), xs))]
    return np.packbits(cells > cells.mean()).tobytes().hex()


_MEDIA = "doc_id bigint, n_bytes bigint, media binary"
_FEATURES = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string, width int, height int, thumbnail_hash string, status string"


def _chunks(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to CHUNK_BYTES; a larger value is a range of its own."""
    start = held = 0
    for k, value in enumerate(column):
        size = value.as_buffer().size if value.is_valid else 0
        if k > start and held + size > CHUNK_BYTES:
            yield start, k
            start, held = k, 0
        held += size
    if len(column) > start:
        yield start, len(column)


def _write_media(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        for low, high in _chunks(texts):
            raw = [x or b"" for x in texts.slice(low, high - low).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), pa.array([len(x) for x in raw], pa.int64()), pa.array([encode(padded(x)) for x in raw], pa.binary())],
                names=["doc_id", "n_bytes", "media"],
            )


def _features(media: list[bytes | None]) -> list[tuple]:
    out: list[tuple] = [(None,) * 8 + ("null",)] * len(media)
    groups: dict[tuple, list[tuple[int, Header]]] = {}
    for k, raw in enumerate(media):
        if raw is not None:
            try:
                header = parse_header(raw)
                groups.setdefault((header.tables, header.interval, header.parts), []).append((k, header))
            except (ValueError, IndexError, struct.error) as why:
                out[k] = (None, None, None, len(raw), hashlib.sha256(raw).hexdigest(), None, None, None, f"bad: {why}")
    for members in groups.values():
        for (k, header), coefficients in zip(members, decode_many([(h, media[k]) for k, h in members])):
            raw = media[k]
            stored = (len(raw), hashlib.sha256(raw).hexdigest())
            if coefficients is None:
                out[k] = (None, None, None, *stored, header.width, header.height, None, "bad: damaged scan")
                continue
            payload = (None, None, None)
            if header.components == 1 and header.comment.startswith(b"payload="):
                data = stored_bytes(header, coefficients)
                payload = (len(data), hashlib.sha256(data).hexdigest(), zlib.crc32(data[-64:]))
            out[k] = (*payload, *stored, header.width, header.height, average_hash(thumbnail(header, coefficients)), "ok")
    return out


def _read_media(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        media = batch.column(2).cast(pa.binary())
        for low, high in _chunks(media):
            found = _features(media.slice(low, high - low).to_pylist())
            size, sha, crc, stored, stored_sha, width, height, thumb, status = (list(x) for x in zip(*found))
            feature = [f"jpeg:{w}x{h}:{t}" if t else None for w, h, t in zip(width, height, thumb)]
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(low, high - low), batch.column(1).slice(low, high - low), *(pa.array(x, t) for x, t in zip((size, sha, crc, stored, stored_sha, feature, width, height, thumb, status), kinds))],
                names=[x.split()[0] for x in _FEATURES.split(", ")],
            )


def store(docs: DataFrame) -> DataFrame:
    """Returns doc_id, n_bytes and the media column with each text's bytes stored. A null text is an empty one; other
    columns are ignored; repeated rows stay rows; an empty table stays empty."""
    return docs.select("doc_id", "text").mapInArrow(_write_media, _MEDIA)


def features(media: DataFrame) -> DataFrame:
    """Reads a media column back: per row dimensions, thumbnail hash, digests of media and of what encode() stored.

    media has doc_id, n_bytes and media; other columns are ignored. A null or damaged image, or one that isn't a
    baseline JPEG with luminance, gets a status that says so and nulls. For foreign images payload columns are null.
    """
    return media.select("doc_id", "n_bytes", "media").mapInArrow(_read_media, _FEATURES)


def op10_media(spark, sf_dir: str) -> DataFrame:
    return features(store(table(spark, sf_dir, "documents")))
