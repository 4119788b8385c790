"""Secret scanning through nested encodings."""

from __future__ import annotations

import base64
import codecs
import re
import zlib
from collections.abc import Iterable, Iterator, Sequence
from hashlib import sha256
from itertools import accumulate, chain, tee

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentinela.llm.common import text_of

# The kinds in their order.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(?a)((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
# Every assignment needs a colon or an equals sign right after its key word.
ASSIGN_SIGNS = re.compile(r"""[dDtTnNyY]["']?\x20*[:=]""")

URL_ESCAPE = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
UNICODE_ESCAPE = re.compile(r"\\u([0-9A-Fa-f]{4})|\\U([0-9A-Fa-f]{8})|\\x([0-9A-Fa-f]{2})|&#x([0-9A-Fa-f]{1,6});|&#([0-9]{1,7});")
# A run of base64 letters, with the lines that go on behind it; 16 letters are the least of a run.
BASE64_RUN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{16,}+(?:[ \t]*+\r?\n[ \t]*+[A-Za-z0-9+/_-]++)*+={0,2}")
BASE64_LINE = re.compile(r"[A-Za-z0-9+/_-]+")
BASE64_LEAST = 16
HEX_RUN = re.compile(r"[0-9A-Fa-f]+")
STREAMS = (b"\x1f\x8b", b"\x78\x01", b"\x78\x5e", b"\x78\x9c", b"\x78\xda")
# Unpacked bytes and text that are in memory together; what unpacks to more is read piece by piece.
PIECE = 1 << 20
# Characters that neighbouring pieces share. A pattern holds in less, since long blanks are shortened.
SHARED = 512
LONG_BLANKS, MOST_BLANKS = re.compile(r"\x20{65,}"), " " * 64
# Characters that no encoding contains, where a piece may end; letters of a run without such an end.
PIECE_END = re.compile(r"[^A-Za-z0-9+/_=\s%\\&#;-]")
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"
# Between the members of a long stream and what follows it; no pattern or encoding goes across.
BREAK = b"\n.\n"
# Bytes that never print, as spaces.
CONTROL = bytes(32 if (i < 32 and i not in b"\t\n\r") or i == 127 else i for i in range(256))

Span = tuple[int, int, str]


class Layer:
    """Decoded text with, for each character, the span of the original text it comes from.

    ``starts`` and ``ends`` are None in the original text, where a character is its own span, and in
    a layer all of which stands for one ``place``.
    """

    __slots__ = ("text", "starts", "ends", "place")

    def __init__(
        self, text: str, starts: list[int] | None = None, ends: list[int] | None = None, place: tuple[int, int] | None = None
    ):
        self.text, self.starts, self.ends, self.place = text, starts, ends, place

    def span(self, start: int, end: int) -> tuple[int, int]:
        """The original span of a non-empty slice."""
        if self.place:
            return self.place
        if self.starts is None:
            return start, end
        return min(self.starts[start:end]), max(self.ends[start:end])

    def pieces(self, start: int, end: int) -> tuple[list[int], list[int]]:
        if self.starts is None:
            return list(range(start, end)), list(range(start + 1, end + 1))
        return self.starts[start:end], self.ends[start:end]


def matches(text: str) -> Iterator[Span]:
    """The base patterns' spans in one text, leftmost and non-overlapping per kind."""
    if ASSIGN_SIGNS.search(text):
        for found in ASSIGN.finditer(text):
            if found.end(2) - found.start(2) >= ASSIGN_LEAST:
                yield found.start(), found.end(), "assign"
    if "AKIA" in text:
        for found in ACCESS.finditer(text):
            if found.end() - found.start() >= ACCESS_LEAST:
                yield found.start(), found.end(), "access"
    for found in HEX.finditer(text):
        yield found.start(), found.end(), "hex"


def readable(text: str) -> str:
    """The text with a space for every character that does not print, and for bytes that are no UTF-8."""
    if text.replace("\n", "").replace("\t", "").replace("\r", "").isprintable():
        return text
    return "".join([c if c.isprintable() or c in "\t\n\r" else " " for c in text])


def telling(text: str) -> bool:
    """Whether a layer of this text holds a span or can be decoded further."""
    patterns = (URL_ESCAPE, UNICODE_ESCAPE, BASE64_RUN)
    return any(pattern.search(text) for pattern in patterns) or next(matches(text), None) is not None


def inflated(chunks: Iterable[bytes]) -> Iterator[bytes]:
    """What a compressed stream given in chunks unpacks to, over all members, in pieces of bounded size.

    Ends with the bytes behind the members, behind a break. Nothing comes where the first bytes are
    no stream or do not unpack; a broken end keeps what came. Zeros may fill up the room between members.
    """
    chunks = iter(chunks)
    data, some = next(chunks, b""), False
    while data.startswith(STREAMS):
        stream = zlib.decompressobj(wbits=47)
        try:
            while not stream.eof:
                piece = stream.decompress(data, PIECE)
                data = stream.unconsumed_tail
                if piece:
                    some = True
                    yield piece
                elif not data and not stream.eof:
                    data = next(chunks, b"")
                    if not data:
                        return
        except zlib.error:
            break
        data = stream.unused_data.lstrip(b"\0")
        while len(data) < 2 and (more := next(chunks, b"")):
            data = (data + more).lstrip(b"\0")
    if some and data:
        yield BREAK
        yield from chain([data], chunks)


def opened(data: bytes) -> Iterator[bytes] | None:
    """Pieces of the bytes behind all directly nested streams; None if ``data`` is no stream.

    A stream that unpacks to itself ends the nesting, as one that does not unpack does.
    """
    chunks: Iterable[bytes] = ()
    first, met = data, set()
    while first.startswith(STREAMS) and (digest := sha256(first).digest()) not in met:
        met.add(digest)
        chunks, tried = tee(chunks)
        inner = inflated(chain([first], tried))
        head = next(inner, None)
        if head is None:  # bytes that only look like a stream
            break
        while len(head) < 2 and (more := next(inner, None)) is not None:
            head += more
        chunks, first = inner, head
    return None if first is data else chain([first], chunks)


def unpacked_texts(chunks: Iterable[bytes]) -> Iterator[str]:
    """Readable text of the bytes, in pieces that share ``SHARED`` characters.

    Pieces end where no encoding goes on. A run of encoded letters longer than ``PIECE`` is cut after
    a whole number of groups of four letters: all of it is decoded, but a compressed stream in it
    ends there, with what came.
    """
    decoder = codecs.getincrementaldecoder("utf-8")("surrogateescape")
    rest, fresh = "", False
    for chunk in chain(chunks, [None]):
        got = decoder.decode(b"", final=True) if chunk is None else decoder.decode(chunk.translate(CONTROL))
        rest, fresh = LONG_BLANKS.sub(MOST_BLANKS, rest + readable(got)), fresh or bool(got)
        if chunk is None or len(rest) < PIECE:
            continue
        found = PIECE_END.search(rest[:SHARED:-1])
        run = len(rest.rstrip(LETTERS))
        end = len(rest) - found.start() if found else run + (len(rest) - run) // 4 * 4
        yield rest[:end]
        rest, fresh = rest[end - SHARED :], False
    if fresh:
        yield rest


def wide_text(data: bytes) -> str | None:
    """The text of bytes that are UTF-16 by their zeros; None for others."""
    if len(data) < BASE64_LEAST // 2 * 2:
        return None
    for zeros, name in ((data[1::2], "utf-16-le"), (data[::2], "utf-16-be")):
        if 10 * zeros.count(0) >= 9 * len(zeros):
            return readable(data[: len(data) // 2 * 2].decode(name, errors="replace"))
    return None


def replaced(layer: Layer, changes: list[tuple[int, int, list[tuple[str, int, int]]]]) -> Layer:
    """The layer with slices replaced; each new character names the slice of the layer it stands for."""
    text: list[str] = []
    starts: list[int] = []
    ends: list[int] = []

    def keep(start: int, end: int) -> None:
        text.append(layer.text[start:end])
        if layer.place:
            return
        a, b = layer.pieces(start, end)
        starts.extend(a)
        ends.extend(b)

    at = 0
    for start, end, characters in changes:
        keep(at, start)
        for character, first, last in characters:
            a, b = layer.span(first, last)
            text.append(character)
            starts.append(a)
            ends.append(b)
        at = end
    keep(at, len(layer.text))
    return Layer("".join(text), place=layer.place) if layer.place else Layer("".join(text), starts, ends)


def url_layer(layer: Layer) -> Iterator[Layer]:
    if "%" not in layer.text:
        return
    changes = []
    for run in URL_ESCAPE.finditer(layer.text):
        data = bytes.fromhex(run[0].replace("%", ""))
        characters, at = [], run.start()
        # Bytes that are no UTF-8 stay one character each, so the length is right.
        for character in data.decode(errors="surrogateescape"):
            width = 3 * len(character.encode(errors="surrogateescape"))
            characters.append((character if character.isprintable() or character in "\t\n\r" else " ", at, at + width))
            at += width
        changes.append((run.start(), run.end(), characters))
    if changes:
        yield replaced(layer, changes)


def unicode_layer(layer: Layer) -> Iterator[Layer]:
    if "\\" not in layer.text and "&#" not in layer.text:
        return
    changes = []
    for run in UNICODE_ESCAPE.finditer(layer.text):
        code = int(run[5]) if run[5] else int(next(group for group in run.groups() if group), 16)
        if code < 0x110000 and not 0xD800 <= code < 0xE000:
            changes.append((run.start(), run.end(), [(chr(code), run.start(), run.end())]))
    if changes:
        yield replaced(layer, changes)


def blob_layers(layer: Layer) -> Iterator[Layer]:
    """Base64 runs decoded, on their line and over line breaks, and compressed ones unpacked."""
    for run in BASE64_RUN.finditer(layer.text):
        lines = [line.span() for line in BASE64_LINE.finditer(layer.text, run.start(), run.end())]
        for start, end in lines:
            stop = run.end() if end == lines[-1][1] else end
            yield from word_layers(layer, layer.text[start:end], range(start, end), [0], stop)
        if len(lines) > 1:
            word = "".join([layer.text[start:end] for start, end in lines])
            spots = [spot for start, end in lines for spot in range(start, end)]
            yield from word_layers(layer, word, spots, [0, *accumulate(end - start for start, end in lines)], run.end())


def word_layers(layer: Layer, word: str, spots: Sequence[int], starts: list[int], stop: int) -> Iterator[Layer]:
    """Layers of one base64 word, whose letters stand at ``spots`` of the layer and whose padding ends at ``stop``.

    The encoding may begin at any of ``starts`` or behind a letter that also separates words. All
    beginnings with the same remainder by four share one decoding. Where the bytes before such a
    beginning are no text, what follows also makes a layer of its own, up to the next such place.
    Words of lower-case letters alone, capitalised ones and hex digits alone are not decoded: they
    are words and digests, and base64 of so many bytes hardly ever looks like them.
    """
    if word.isalpha() and (word.islower() or word[1:].islower()) or HEX_RUN.fullmatch(word):
        return  # a plain word, or a digest
    starts = sorted({*starts, *(found.end() for found in SEPARATOR.finditer(word))})
    starts = [start for start in starts if len(word) - start >= BASE64_LEAST]
    letters = word.translate(URL_SAFE)
    for remainder in range(4):
        alike = [start for start in starts if start % 4 == remainder]
        if not alike:
            continue
        first = alike[0]
        # A single last letter stands for no byte.
        rest = letters[first : len(word) - ((len(word) - first) % 4 == 1)]
        data = base64.b64decode(rest + "=" * (-len(rest) % 4), validate=True)
        streams = set()
        for start in alike:
            at = (start - first) // 4 * 3
            if data.startswith(STREAMS, at):
                found = opened(data[at:])
                if found is not None:
                    streams.add(start)
                    for text in unpacked_texts(found):
                        if telling(text):
                            yield Layer(text, place=layer.span(spots[start], stop))
        fresh = [start for start in alike[1:] if not PLAIN.fullmatch(data, (start - first) // 4 * 3 - 3, (start - first) // 4 * 3)]
        pieces = [(first, len(data)), *((a, (b - first) // 4 * 3) for a, b in zip(fresh, [*fresh[1:], first + 4 * len(data)]))]
        for start, end in pieces:
            if start in streams:
                continue
            part = data[(start - first) // 4 * 3 : end]
            wide = wide_text(part)
            if wide is not None and telling(wide):
                yield Layer(wide, place=layer.span(spots[start], stop))
            raw = part.decode(errors="surrogateescape")
            text = readable(raw)
            if telling(text):
                yield Layer(text, place=layer.place) if layer.place else Layer(text, *letter_spans(layer, raw, spots, start))


def letter_spans(layer: Layer, raw: str, spots: Sequence[int], start: int) -> tuple[list[int], list[int]]:
    """For each character decoded from the letters from ``start`` on, the original span of its letters."""
    starts, ends, at = [], [], 0
    for character in raw:
        width = len(character.encode(errors="surrogateescape"))
        # Three bytes stand in four letters; a byte touches two of them.
        first, last = start + at * 8 // 6, min(start + ((at + width) * 8 + 5) // 6, len(spots))
        a, b = layer.span(spots[first], spots[last - 1] + 1)
        starts.append(a)
        ends.append(b)
        at += width
    return starts, ends


# Letters of base64 that also stand between words, as in paths.
SEPARATOR = re.compile(r"[+/_-]")
PLAIN = re.compile(rb"[\t\n\r\x20-\x7E]*")
URL_SAFE = str.maketrans("-_", "+/")
DECODERS = (url_layer, unicode_layer, blob_layers)


def scan(text: str | None) -> tuple[list[Span], list[Span]]:
    """Base spans of the text itself, and all spans, those of decoded layers mapped to the text.

    The worklist holds, for each layer with more to come out of it, the next one; the last goes first. A layer whose text was met at the same place is not taken up again, so
    decoding ends at the fixpoint even if an encoding decodes to itself. URL, Unicode and base64
    decoding shorten the text. Unpacking may lengthen it by a factor of about a thousand for each
    compressed layer: streams in streams, with all members of each, are unpacked and scanned piece
    by piece, so memory is bounded by the text and the depth of the nesting. Base64 of UTF-16 is
    read as such where its zeros tell.
    """
    text = text or ""
    base = sorted(matches(text), key=place)
    spans = set(base)
    met: set[tuple] = set()
    work = waiting(decoded(Layer(text)))
    while work:
        found, layers = work.pop()
        work += waiting(layers)
        key = (sha256(found.text.encode(errors="surrogatepass")).digest(), *found.span(0, len(found.text)))
        if key in met:
            continue
        met.add(key)
        for start, end, kind in matches(found.text):
            spans.add((*found.span(start, end), kind))
        work += waiting(decoded(found))
    return base, sorted(spans, key=place)


def decoded(layer: Layer) -> Iterator[Layer]:
    """The layers that come out of one, each decoded when it is asked for."""
    for decode in DECODERS:
        for found in decode(layer):
            if found.text and found.text != layer.text:
                yield found


def waiting(layers: Iterator[Layer]) -> list[tuple[Layer, Iterator[Layer]]]:
    """The next of the layers with those behind it; nothing if there is none."""
    found = next(layers, None)
    return [] if found is None else [(found, layers)]


def place(span: Span) -> tuple:
    return span[0], KINDS.index(span[2]), span[1]


def written_spans(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def redact(text: str, spans: list[Span], mark: str = "[{kind}]") -> str:
    """The text with each run of touching or overlapping spans replaced by its first span's mark."""
    out, at = [], 0
    i = 0
    while i < len(spans):
        start, end, kind = spans[i]
        i += 1
        while i < len(spans) and spans[i][0] <= end:
            end = max(end, spans[i][1])
            i += 1
        out += [text[at:start], mark.format(kind=kind)]
        at = end
    return "".join([*out, text[at:]])


FOUND = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def secret_spans(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans and all spans (code points, end exclusive) per document.

    Nulls: a null text is empty, a null doc_id stays null. Long texts are scanned whole. Repeated
    rows come out each, an empty table gives no rows, other columns are not read. A compressed
    stream that does not unpack makes no layer; in bytes that are no text, what is none counts as
    spaces.
    """

    def found(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                base, spans = scan(text)
                counts = [sum(span[2] == kind for span in base) for kind in KINDS]
                digest = sha256(written_spans(base).encode()).hexdigest()
                rows.append((None if pd.isna(doc_id) else int(doc_id), *counts, digest, written_spans(spans)))
            names = [part.split()[0] for part in FOUND.split(", ")]
            yield pd.DataFrame(rows, columns=names).astype({"doc_id": "Int64"})

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInPandas(found, FOUND)


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every secret replaced by its kind in brackets and ``n_chars`` counted anew."""

    @F.pandas_udf(T.StringType())
    def clean(texts: pd.Series) -> pd.Series:
        results = []
        for text in texts:
            spans = scan(text)[1] if text else []
            results.append(redact(text, spans) if spans else text)
        return pd.Series(results, dtype=object)

    rows = docs.withColumn("text", clean("text"))
    if "n_chars" in rows.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(docs.columns)
