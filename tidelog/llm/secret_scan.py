"""Secret scan: a worklist of decoded layers, rescanned to a fixpoint.

The plain text is the first layer. In each layer, runs that are percent-encoded,
escaped Unicode, base64 or, behind one of these, compressed are unwrapped into
new layers, and every layer is scanned for the same patterns. A layer that was
seen before in the document is not taken up again, so a cycle ends. Each decoded
character keeps the range of the original text it came from; a finding in a
layer is reported as that range.

Rows are independent, so the scan is one pass over the documents without a
shuffle, and a text is held by one task at a time.

Decoded layers are bytes first. What is compressed is unpacked again until it is
not, over all members of gzip and frames of zstandard; only then it is read as text.
Unpacked layers over `max_layer_bytes` are read as a stream of overlapping blocks, so
that memory is bounded whatever they unpack to, and counted in `split_layers`. Every
run without white space of up to half a block, and whatever else is at most `OVERLAP`
bytes long, lies whole within a block. As all places of a compressed layer stand for
one range of the text, matches in two blocks are one finding.

Defined results: a null text is an empty one; repeated rows come back as often
as they came in; equal findings of several layers count once; columns other than
those named are passed through by `find_secrets` untouched. A damaged or truncated
compressed layer is unpacked as far as it goes and read as it is as well; deflate
without a header isn't recognised, and zstandard windows over 2 GB count as damaged.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import itertools
import re
import zlib

import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidelog.llm.common import registered, table

#: The patterns, in the order in which kinds are listed.
KINDS = ["assign", "access", "hex"]
ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_ASSIGNED = 6

ESCAPE = re.compile(r"%[0-9A-Fa-f]{2}|\\u[0-9A-Fa-f]{4}|\\x[0-9A-Fa-f]{2}|&#(?:x[0-9A-Fa-f]{1,6}|[0-9]{1,7});")
SPACE_BEFORE = re.compile(r"\S*\Z")
RUN = re.compile(r"\S*")
#: The shortest secret, `token=` and six characters, takes sixteen letters.
LEAST_RUN = 16
#: Runs of both alphabets, and of each for what lies behind a sign of the other.
BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
ONE_ALPHABET = [re.compile(r"[A-Za-z0-9+/]{16,}={0,2}"), re.compile(r"[A-Za-z0-9_-]{16,}={0,2}")]
#: Runs that go on in the next lines, and their parts.
WRAPPED = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{4,}(?:[ \t]*\r?\n[ \t]*[A-Za-z0-9+/_-]+)+={0,2}")
PART = re.compile(r"[A-Za-z0-9+/_-]+")
CONTROL = re.compile(r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]")
UPPER_OR_DIGIT = re.compile(r"[A-Z0-9]")

MAX_LAYER_BYTES = 32 * 1024 * 1024
#: Bytes that two blocks of a large layer share.
OVERLAP = 1 << 20
#: Compressed bytes taken in at a time; of zstandard fewer, as 4 can stand for 128 KB.
PIECE, ZSTD_PIECE = 1 << 14, 1 << 8
#: Unpacked bytes handed on at a time.
UNPACKED = 1 << 16

FINDINGS = "array<struct<start:bigint,kind:int,end:bigint,depth:int,value:string>>"


def scan(text: str):
    """(kind number, start, end) of every match in one layer."""
    found = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= MIN_ASSIGNED]
    found += [(1, m.start(), m.end()) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return found


def _unpacker(data: bytes):
    """What decompresses `data`, by its first bytes, and how much it takes at a time."""
    if data[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor(max_window_size=1 << 31).decompressobj(), ZSTD_PIECE
    if data[:3] == b"\x1f\x8b\x08" or _zlib_header(data):
        return zlib.decompressobj(47), PIECE
    return None, 0


def _zlib_header(data: bytes) -> bool:
    """Deflate, a window of at most 32 KB, no dictionary, and the check of both bytes."""
    return len(data) > 2 and data[0] & 15 == 8 and data[0] < 128 and not data[1] & 32 and (data[0] * 256 + data[1]) % 31 == 0


class Unpacked:
    """Decompressed pieces of all members that stand one after the other in `chunks`.

    `clean` tells afterwards whether the last member was whole, `rest` holds what
    follows it as an iterator of bytes.
    """

    def __init__(self, chunks):
        self.pieces = (bytes(c[i : i + PIECE]) for c in chunks for i in range(0, len(c), PIECE))
        self.clean, self.rest = True, iter(())

    def __iter__(self):
        pending = b""
        while True:
            while len(pending) < 4 and (piece := next(self.pieces, b"")):
                pending += piece
            unpacker, step = _unpacker(pending)
            if unpacker is None:
                break
            try:
                while not unpacker.eof:
                    pending = pending or next(self.pieces, b"")
                    if not pending:
                        self.clean = False
                        if step == PIECE:
                            yield unpacker.flush()
                        return
                    if step == PIECE:
                        out = unpacker.decompress(pending, UNPACKED)
                        pending = unpacker.unused_data if unpacker.eof else unpacker.unconsumed_tail
                    else:
                        out = unpacker.decompress(pending[:step])
                        pending = (unpacker.unused_data if unpacker.eof else b"") + pending[step:]
                    if out:
                        yield out
            except (zlib.error, zstandard.ZstdError):
                self.clean = False
                return
        self.rest = itertools.chain([pending], self.pieces)

    def with_rest(self):
        """The pieces, and then what follows the last member."""
        yield from self
        yield from self.rest


def measured(data: bytes):
    """How many bytes of `data` are whole compressed members (0 if none), and whether
    anything can be unpacked at all."""
    if _unpacker(data)[0] is None:
        return 0, False
    pieces = Unpacked([data])
    some = any([True for piece in pieces if piece])
    return len(data) - sum(map(len, pieces.rest)) if pieces.clean else 0, some or pieces.clean


def _blocks(head: bytes, chunks, limit: int):
    """Overlapping blocks of at most `limit` bytes, cut at white space where the second half has any."""
    block = bytearray(head)
    overlap = min(OVERLAP, limit // 8) & ~1
    more = True
    while more:
        while len(block) <= limit and (more := (chunk := next(chunks, None)) is not None):
            block += chunk
        if len(block) <= limit:
            yield bytes(block)
            return
        cut = max(block.rfind(space, limit // 2, limit) for space in (b" ", b"\n", b"\t"))
        cut = cut + 1 if cut >= 0 else limit & ~1
        yield bytes(block[:cut])
        # the shared part begins with a whole run as well, if one begins in it
        back = max(block.rfind(space, cut - 2 * overlap, cut - overlap) for space in (b" ", b"\n", b"\t"))
        back = (back if back >= 0 else cut - overlap) & ~1
        del block[:back]
        more = True


def layer_bytes(chunks, limit: int):
    """Bytes of every layer below `chunks` that is not compressed, or not as a whole, in blocks
    of at most `limit`, and whether it is one of several blocks."""
    seen, whole = set(), False
    while True:
        chunks, head, whole = iter(chunks), bytearray(), True
        for chunk in chunks:
            head += chunk
            if len(head) > limit:
                whole = False
                break
        head = bytes(head)
        key = hashlib.blake2b(head, digest_size=16).digest()
        if key in seen:
            return
        seen.add(key)
        unpacked = Unpacked(itertools.chain([head], chunks)) if _unpacker(head)[0] else None
        if unpacked and whole:
            used, some = measured(head)
            if not used and len(seen) > 1:
                yield head, False
            if not some:
                return
        elif unpacked and head[:2] not in (b"\x1f\x8b", b"\x28\xb5", b"\x78\x01", b"\x78\x9c", b"\x78\xda"):
            # too large to try first, and likely a text that begins so by chance
            unpacked = None
        if not unpacked:
            break
        chunks = unpacked.with_rest()
    if whole:
        yield head, False
    else:
        for block in _blocks(head, chunks, limit):
            yield block, True


def _decoded(data: bytes, part: bool):
    """`data` as UTF-8, or None; a `part` of a layer may begin and end within a character."""
    try:
        return data.decode("utf-8")
    except UnicodeDecodeError:
        if not part:
            return None
    start = next((i for i in range(min(4, len(data))) if data[i] & 0xC0 != 0x80), 0)
    for end in range(len(data), max(start, len(data) - 4), -1):
        try:
            return data[start:end].decode("utf-8")
        except UnicodeDecodeError:
            continue
    return None


def readings(data: bytes, part: bool = False):
    """Each way to read `data` as text, and whether it is clean UTF-8.

    What is not UTF-8 is read as Latin-1; with many zero bytes it may be UTF-16 as well.
    """
    text = _decoded(data, part)
    found = [data.decode("latin-1") if text is None else text]
    clean = text is not None and not CONTROL.search(text)
    if not clean and 3 * data.count(0) >= len(data):
        found += [data[: len(data) // 2 * 2].decode(code, "replace") for code in ("utf-16-le", "utf-16-be")]
    return found, clean


def _sizes(data: bytes, ways: list[str]):
    """The readings with the bytes that each of their characters takes."""
    latin = len(ways[0]) == len(data)
    yield ways[0], [1] * len(data) if latin else [len(char.encode("utf-8")) for char in ways[0]]
    for text in ways[1:]:
        sizes = [4 if ord(char) > 0xFFFF else 2 for char in text]
        if sum(sizes) <= len(data):
            yield text, sizes


def _wrapped(text: str):
    """Offsets of the letters of runs that may be wrapped over lines."""
    for match in WRAPPED.finditer(text):
        parts = [range(m.start() + match.start(), m.end() + match.start()) for m in PART.finditer(match[0])]
        chains, i = [parts], 0
        while i < len(parts):
            # lines of one width, and a last one that may be shorter
            j = i + 1
            while j < len(parts) and len(parts[j]) == len(parts[i]):
                j += 1
            chains.append(parts[i:j])
            if j < len(parts) and len(parts[j]) < len(parts[i]):
                chains.append(parts[i : j + 1])
            i = j
        for chain in {(c[0].start, c[-1].stop): c for c in chains if len(c) > 1}.values():
            places = [k for part in chain for k in part]
            if len(places) >= LEAST_RUN:
                yield places


def _escaped_runs(text: str):
    """Runs without white space that hold an escape: (start, end)."""
    end = 0
    for match in ESCAPE.finditer(text):
        if match.start() < end:
            continue
        start = match.start()
        while start > end and not text[start - 1].isspace():
            start -= 1
        end = RUN.match(text, match.start()).end()
        yield start, end


def _unescape(run: str):
    """The run without one level of escapes, with the source range of each character.

    Bytes of neighbouring %XX or \\xXX form one UTF-8 sequence; bytes that are not
    UTF-8 stand for themselves. Also returns the run as bytes, in which an escape below
    256 is one byte, with the source range of each.
    """
    out, spans, raw, places, at = [], [], bytearray(), [], 0
    pending: list[tuple[int, int, int]] = []

    def plain(start, end):
        out.extend(run[start:end])
        spans.extend((k, k + 1) for k in range(start, end))
        for k in range(start, end):
            data = run[k].encode("utf-8", "surrogatepass")
            raw.extend(data)
            places.extend([(k, k + 1)] * len(data))

    def flush():
        if not pending:
            return
        data = bytes(b for b, _, _ in pending)
        raw.extend(data)
        places.extend((a, b) for _, a, b in pending)
        i = 0
        while i < len(data):
            for size in (1, 2, 3, 4):
                try:
                    char = data[i : i + size].decode("utf-8")
                    break
                except UnicodeDecodeError:
                    char = None
            if not char:
                char, size = chr(data[i]), 1
            size = min(size, len(data) - i)
            out.append(char)
            spans.append((pending[i][1], pending[i + size - 1][2]))
            i += size
        pending.clear()

    for match in ESCAPE.finditer(run):
        if match.start() > at:
            flush()
            plain(at, match.start())
        token, at = match[0], match.end()
        if token[0] == "%" or token[1] == "x":
            pending.append((int(token.lstrip("%\\x") or "0", 16), match.start(), at))
            continue
        flush()
        if token[0] == "&":
            code = int(token[3:-1], 16) if token[2] == "x" else int(token[2:-1])
        else:
            code = int(token[2:], 16)
        char = chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"
        out.append(char)
        spans.append((match.start(), at))
        data = bytes([code]) if code < 256 else char.encode("utf-8")
        raw.extend(data)
        places.extend([(match.start(), at)] * len(data))
    flush()
    plain(at, len(run))
    return "".join(out), spans, bytes(raw), places


#: The first bytes of gzip, zstandard and zlib streams.
MAGIC = re.compile(rb"\x1f\x8b\x08|\x28\xb5\x2f\xfd|\x78[\x01\x5e\x9c\xda]")


def _members(raw: bytes):
    """(start, end) of compressed streams within bytes; what is cut off ends with them."""
    at = 0
    while match := MAGIC.search(raw, at):
        start = match.start()
        used, some = measured(raw[start:])
        if used or some:
            yield start, start + used if used else len(raw)
        at = start + used if used else match.end()


def _base64(token: str) -> bytes | None:
    body = token.rstrip("=")
    if len(body) % 4 == 1 or not UPPER_OR_DIGIT.search(body):
        return None
    try:
        return base64.b64decode(body.replace("-", "+").replace("_", "/") + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def layers_of(text: str, limit: int, flat: bool = False):
    """Layers one step below `text`: (layer, spans per character or one span, whether it is
    one of several blocks). With `flat`, spans are those of whole runs."""

    def opened(data: bytes, start: int, end: int):
        for block, part in layer_bytes([data], limit):
            for layer in readings(block, part)[0]:
                yield layer, (start, end), part

    if "%" in text or "\\" in text or "&#" in text:
        for start, end in _escaped_runs(text):
            layer, spans, raw, places = _unescape(text[start:end])
            yield layer, (start, end) if flat else [(start + a, start + b) for a, b in spans], False
            # in a form, a plus that is not escaped is a space
            form = bytes(32 if c == 43 and b - a == 1 else c for c, (a, b) in zip(raw, places)) if b"+" in raw else raw
            for data in dict.fromkeys((raw, form)):
                for a, b in _members(data):
                    yield from opened(data[a:b], start + places[a][0], start + places[b - 1][1])

    def decoded(places):
        """What the letters at `places` stand for; returns whether that is clean."""
        data = _base64("".join(map(text.__getitem__, places)) if isinstance(places, list) else text[places.start : places.stop])
        if data is None:
            return False
        used, some = measured(data)
        if some:
            yield from opened(data, places[0], places[-1] + 1)
            if used:
                return True
        ways, clean = readings(data)
        if flat:
            for layer in ways:
                yield layer, (places[0], places[-1] + 1), False
            return clean
        for layer, sizes in _sizes(data, ways):
            # three bytes come from four letters; characters take whole bytes
            spans, at = [], 0
            for size in sizes:
                spans.append((places[at * 4 // 3], places[-(-(at + size) * 4 // 3) - 1] + 1))
                at += size
            yield layer, spans, False
        return clean

    for match in BASE64.finditer(text):
        clean = yield from decoded(range(*match.span()))
        if not clean:
            inner = {m.span() for run in ONE_ALPHABET for m in run.finditer(text, *match.span())} - {match.span()}
            for span in sorted(inner):
                yield from decoded(range(*span))
    if "\n" in text:
        for places in _wrapped(text):
            yield from decoded(places)


def _key(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def secrets(text: str, limit: int = MAX_LAYER_BYTES):
    """Findings of one text, (start, kind, end, depth, value) in order, and the number of
    blocks that layers over the limit were read in.

    A layer is done with all that lies below it before the next one is unpacked, so one
    layer, or one block of it, is held for each step of depth. Layers seen are known by
    128 bits.
    """
    found = {(s, k, e): (0, text[s:e]) for k, s, e in scan(text)}
    seen, split = {_key(text)}, 0
    work = [(layers_of(text, limit), None)]
    while work:
        below, origin = work[-1]
        step = next(below, None)
        if step is None:
            work.pop()
            continue
        inner, spans, part = step
        split += part
        key = _key(inner)
        if key in seen:
            continue
        seen.add(key)
        if origin is None:
            mapped = spans
        elif isinstance(origin, tuple):
            mapped = origin
        elif isinstance(spans, tuple):
            mapped = (origin[spans[0]][0], origin[spans[1] - 1][1])
        else:
            mapped = [(origin[a][0], origin[b - 1][1]) for a, b in spans]
        one = isinstance(mapped, tuple)
        for kind, start, end in scan(inner):
            first, last = mapped if one else (mapped[start][0], mapped[end - 1][1])
            found.setdefault((first, kind, last), (len(work), inner[start:end]))
        work.append((layers_of(inner, limit, one), mapped))
    return [(s, k, e, d, v) for (s, k, e), (d, v) in sorted(found.items())], split


def find_secrets(docs: DataFrame, text: str = "text", max_layer_bytes: int = MAX_LAYER_BYTES) -> DataFrame:
    """`docs` with `findings` (start, kind number, end, depth, value) and `split_layers`.

    Start and end count code points of the text, the end not included.
    """
    kept = [f for f in docs.schema.fields if f.name not in (text, "findings", "split_layers")]
    findings = docs.sparkSession.range(0).selectExpr(f"CAST(NULL AS {FINDINGS}) AS findings").schema["findings"]
    schema = StructType([*kept, findings, StructField("split_layers", IntegerType())])

    def scanned(batches):
        for batch in batches:
            results = [secrets(x or "", max_layer_bytes) for x in batch[text]]
            out = batch[[f.name for f in kept]].copy()
            out["findings"] = pd.Series(
                [[dict(zip(("start", "kind", "end", "depth", "value"), x)) for x in found] for found, _ in results],
                index=out.index,
                dtype=object,
            )
            out["split_layers"] = [split for _, split in results]
            yield out

    return docs.select(*(f.name for f in kept), text).mapInPandas(scanned, schema)


@registered("op9_secret_scan")
def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    names = f"array({', '.join(repr(k) for k in KINDS)})"
    joined = f"array_join(transform({{}}, f -> concat({names}[f.kind], ':', f.start, ':', f.end)), ',')"
    return (
        find_secrets(docs)
        .withColumn("findings", F.expr("array_sort(findings)"))
        .withColumn("base", F.expr("filter(findings, f -> f.depth = 0)"))
        .selectExpr(
            "doc_id",
            *(f"CAST(size(filter(base, f -> f.kind = {i})) AS BIGINT) AS n_{k}" for i, k in enumerate(KINDS)),
            f"sha2({joined.format('base')}, 256) AS base_sha256",
            f"{joined.format('findings')} AS spans",
            "split_layers",
        )
    )
