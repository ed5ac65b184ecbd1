"""Byte-level BPE ids of whole texts, exactly as the tokenizer gives them, with a bounded memory of pieces.

The bytes of many texts are cut into the tokenizer's pre-tokens by a few numpy passes over classes of bytes: between ASCII
characters their classes tell where a token ends. Where a byte is not ASCII, the characters around it stay together, and
the tokenizer's pattern parts them. The different pieces are found in Arrow, and each goes through the tokenizer's model once
and is remembered. Texts in which white space outside ASCII meets other white space, or with control characters that count
as space in some tables only, are encoded as a whole by the same tokenizer.
"""

from __future__ import annotations

import codecs
import re
import sys
import types
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Pieces remembered per worker process in each of two generations, and the longest that is remembered.
CACHE_PIECES, CACHE_CHARS = 300_000, 48
#: Characters whose pieces are looked up together.
GROUP_CHARS = 1 << 23
#: Pieces up to this length skip the tokenizer's own bookkeeping of offsets.
SHORT = 200
#: White space between visible characters, where a long text may be parted: a token begins with it.
_PART_AT = re.compile(r"(?<=\S)[ \t\n\r](?=\S)")
#: Classes of bytes; those up to ``_BLANK`` are white space.
_SPACE, _BLANK, _LETTER, _DIGIT, _MARK, _WIDE, _ODD = range(7)


def _classes() -> np.ndarray:
    """The class of each byte."""
    kind = np.full(256, _MARK, np.uint8)
    for name, values in ((_SPACE, b" "), (_BLANK, b"\t\n\v\f\r"), (_DIGIT, b"0123456789"), (_ODD, b"\0\x1c\x1d\x1e\x1f")):
        kind[list(values)] = name
    kind[65:91] = kind[97:123] = _LETTER
    kind[128:] = _WIDE
    return kind


def _parting() -> np.ndarray:
    """By 8 x class + class of the next byte: whether a token begins between them."""
    a, b = np.divmod(np.arange(64), 8)
    return (a != b) & ~((a == _SPACE) & (b > _BLANK)) & ~((a <= _BLANK) & (b <= _BLANK))


_KIND, _PARTS = _classes(), _parting()


def _byte_letters() -> str:
    """Byte-level alphabet, a letter per byte: printable bytes stand for themselves, the others follow from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [b for b in range(256) if b not in printable]
    return "".join(chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256))


def _load(path: str) -> types.SimpleNamespace:
    """What a worker process remembers of ``path``: as much as within one task, and kept for its next one.

    Functions travel by value and lose their globals with the task; the memory lies in a module of its own. It only saves time.
    """
    memory = vars(sys.modules.setdefault("seriesmill_pieces", types.ModuleType("seriesmill_pieces")))
    state = memory.get(path)
    if state is None:
        import regex
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        state = memory[path] = types.SimpleNamespace(
            tokenizer=tokenizer, model=tokenizer.model, parts=regex.compile(PATTERN).findall, letters=_byte_letters(), young={}, old={}
        )
    return state


def _pack(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


def _part(state, part: str) -> bytes:
    letters = codecs.charmap_decode(part.encode(), "strict", state.letters)[0]
    return _pack([t.id for t in state.model.tokenize(letters)])


def _learn(state, pieces: list[str]) -> list[bytes]:
    """Ids of each piece that is not among the young ones."""
    young, old = state.young, state.old
    out = []
    for piece in pieces:
        got = old.get(piece)
        if got is None:
            if len(piece) > SHORT:
                got = _pack(state.tokenizer.encode(piece, add_special_tokens=False).ids)
            elif piece.isascii() or piece[piece[0] == " " :].isalpha():
                got = _part(state, piece)
            else:
                got = b"".join([_part(state, p) for p in state.parts(piece)])
        if len(piece) <= CACHE_CHARS:
            young[piece] = got
        out.append(got)
    if len(young) >= CACHE_PIECES:
        state.young, state.old = {}, young
    return out


def _contractions(data: np.ndarray, kind: np.ndarray, cut: np.ndarray, first: np.ndarray) -> None:
    """'s 't 'm 'd 're 've 'll are tokens of their own where the apostrophe begins one. After a byte outside ASCII that is not known."""
    at = np.flatnonzero(data == 39)
    at = at[at + 1 < len(data)]
    at = at[(first[at] | ((kind[at - 1] != _MARK) & (kind[at - 1] != _SPACE) & (kind[at - 1] != _WIDE))) & ~first[at + 1]]
    one = at[np.isin(data[at + 1], list(b"stmd"))]
    two = at[at + 2 < len(data)]
    two = two[np.isin(data[two + 1].astype(np.int64) * 256 + data[two + 2], [int.from_bytes(x) for x in (b"re", b"ve", b"ll")]) & ~first[two + 2]]
    cut[one + 1] = cut[two + 1] = False
    for after in (one + 2, two + 3):
        cut[after[after < len(data)]] = True


def _starts(data: np.ndarray, kind: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces begin in ``data``, whose texts lie between ``bounds``: tokens, or several that hold bytes outside ASCII."""
    n = len(data)
    cut = np.empty(n, bool)
    cut[1:] = _PARTS[(kind[:-1] << 3) | kind[1:]]
    first = np.zeros(n, bool)
    first[bounds[:-1][bounds[:-1] < n]] = True
    # the last of several white spaces goes with what follows, or stands alone
    white = kind <= _BLANK
    last = np.flatnonzero(white[1:-1] & white[:-2] & ~white[2:]) + 1
    cut[last[~first[last + 1]]] = True
    _contractions(data, kind, cut, first)
    cut |= first
    at = np.flatnonzero(cut)
    of = kind[np.append(at[1:], n) - 1]  # a piece has one class, but for the space before it
    wide = of == _WIDE
    if wide.any():
        joined = np.zeros(len(at), bool)
        joined[1:] = (kind[at[1:]] > _BLANK) & (of[:-1] > _BLANK) & ~first[at[1:]]
        keep = np.zeros(len(at), bool)
        keep[1:] = wide[1:] | wide[:-1]
        keep &= joined
        # marks behind a wide byte may belong to it, and an apostrophe to what follows
        keep[2:] |= joined[2:] & (of[1:-1] == _MARK) & keep[1:-1] & wide[:-2]
        at = at[~keep]
    return at


def _encode_group(state, texts: list[str]) -> list[bytes]:
    """Ids of some texts: their pieces are told apart in Arrow, and each different one is looked up once."""
    held = pa.array(texts, pa.large_string())
    _, bounds, data = held.buffers()
    bounds = np.frombuffer(bounds, np.int64, len(texts) + 1)
    if bounds[-1] == 0:
        return [b""] * len(texts)
    raw = np.frombuffer(data, np.uint8, bounds[-1])
    kind = _KIND[raw]
    at = _starts(raw, kind, bounds)
    odd = np.flatnonzero(kind == _ODD)
    coded = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(np.append(at, bounds[-1])), data).dictionary_encode()
    different, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
    del kind, coded
    unclear = [k for k, piece in enumerate(different) if not piece.isascii() and (piece[-1].isspace() or piece[piece[0] == " "].isspace())]
    if unclear:
        odd = np.append(odd, at[np.isin(code, unclear)])
    pieces = list(map(state.young.get, different))
    new = [k for k, got in enumerate(pieces) if got is None]
    for k, got in zip(new, _learn(state, [different[k] for k in new])):
        pieces[k] = got
    flat = np.frombuffer(b"".join(pieces), np.uint32)
    size = np.fromiter(map(len, pieces), np.int32, len(pieces)) // 4
    start = np.cumsum(size, dtype=np.int32) - size
    many = size[code]
    ends = np.cumsum(many, dtype=np.int32)
    where = np.repeat(start[code] - (ends - many), many)
    where += np.arange(len(where), dtype=np.int32)
    ids = flat[where].tobytes()
    cuts = (4 * np.append(np.int64(0), ends)[np.searchsorted(at, bounds)]).tolist()
    out = [ids[s:e] for s, e in zip(cuts, cuts[1:])]
    for k in set((np.searchsorted(bounds, odd, side="right") - 1).tolist()):
        out[k] = _pack(state.tokenizer.encode(texts[k], add_special_tokens=False).ids)
    return out


def encode_all(texts: Iterable[str], path: str) -> Iterator[bytes]:
    """Ids of each text in order, as little-endian unsigned 32-bit numbers; about ``GROUP_CHARS`` of text are held at a time.

    A longer text is taken in parts that begin with a white space between visible characters.
    """
    state = _load(path)
    held: list[str] = []
    size = 0
    for text in texts:
        long = len(text) > GROUP_CHARS
        if held and (long or size + len(text) > GROUP_CHARS):
            yield from _encode_group(state, held)
            held, size = [], 0
        if long:
            cuts = [0]
            while found := _PART_AT.search(text, cuts[-1] + GROUP_CHARS):
                cuts.append(found.start())
            yield b"".join(_encode_group(state, [text[s:e]])[0] for s, e in zip(cuts, [*cuts[1:], len(text)]))
        else:
            held.append(text)
            size += len(text)
    if held:
        yield from _encode_group(state, held)


def encode(text: str, path: str) -> bytes:
    """Ids of one text."""
    return next(encode_all([text], path))
