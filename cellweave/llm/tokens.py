"""Token ids and counts of whole texts, exactly as the tokenizers library gives them.

The library spends about a microsecond on each character. A text's ids are those of its pieces one after
another, where a piece is what the tokenizer's own pattern cuts out before merging. So each distinct piece
goes to the library once per worker process, many joined to one call, and is remembered; the rest is Arrow and numpy work.
Pieces are cut here only within Latin-1 strings without special strings; anything else goes to the library as it is.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from cellweave.llm.common import coded, codes, split_words

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Pieces that one process remembers; beyond that it forgets all and starts again.
REMEMBERED = 300_000
#: Pieces joined to one call of the library.
JOINED = 500
#: In Latin-1: letters, numbers and white space as Unicode classes them.
LETTER, NUMBER, SPACE = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
CONTRACTED = "'s|'t|'re|'ve|'m|'ll|'d"
WORD_PIECE = re.compile(f"{CONTRACTED}|[{LETTER}]+|[{NUMBER}]|[^{SPACE}{LETTER}{NUMBER}]+")
BYTE_PIECE = re.compile(f"{CONTRACTED}| ?[{LETTER}]+| ?[{NUMBER}]+| ?[^{SPACE}{LETTER}{NUMBER}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: All white space of Unicode, for the texts where a space has another one beside it.
ALL_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CHUNK = re.compile(f"[{ALL_SPACE}]*[^{ALL_SPACE}]+|[{ALL_SPACE}]+")
RE2_SPACE = re.sub(r"\\[ux]([0-9a-f]+)", r"\\x{\1}", ALL_SPACE)
SPACE_BESIDE_SPACE = f"[{RE2_SPACE}] | [{RE2_SPACE}]"


def simple(chunk: str) -> bool:
    """Whether the patterns above cut this string as the library would."""
    if "<|" in chunk:
        return False
    try:
        chunk.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Memory(dict):
    """Pieces and what is known of them, bounded."""

    def full(self, more: int) -> bool:
        """Whether there was no room for so many more, and all is forgotten."""
        if len(self) + more <= REMEMBERED:
            return False
        self.clear()
        return True


class WordBpe:
    """For a tokenizer that lower-cases, drops white space and marks word ends (word_bpe_49k.json)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        vocab = self.library.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if max(vocab.values()) < 65536 else np.dtype("<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.ends[[i for piece, i in vocab.items() if piece.endswith("</w>")]] = True
        self.known = Memory()

    def plain(self, strings: list[str]) -> list[np.ndarray]:
        return [np.array(x.ids, dtype=self.dtype) for x in self.library.encode_batch_fast(strings, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> None:
        groups = [pieces[i : i + JOINED] for i in range(0, len(pieces), JOINED)]
        size = self.dtype.itemsize
        for group, ids in zip(groups, self.plain([" ".join(g) for g in groups]), strict=True):
            ends = ((np.flatnonzero(self.ends[ids]) + 1) * size).tolist()
            if len(ends) == len(group):
                held = ids.tobytes()
                each = [held[a:b] for a, b in zip([0, *ends], ends, strict=False)]
            else:
                each = [x.tobytes() for x in self.plain(group)]
            self.known.update(zip(group, each, strict=True))

    def of_pieces(self, pieces: list[str]) -> list[bytes]:
        known = self.known
        found = list(map(known.get, pieces))
        missing = [p for p, x in zip(pieces, found, strict=True) if x is None]
        if missing:
            if known.full(len(missing)):
                missing = list(dict.fromkeys(pieces))
            self.learn(list(dict.fromkeys(missing)))
            found = [known[p] for p in pieces]
        return found

    def of_chunks(self, chunks: pa.Array) -> list[bytes]:
        """The ids of strings without ASCII white space, as bytes."""
        parts = pc.extract_regex(chunks, f"^(?P<body>[{LETTER}]+)(?P<tail>[.,;:!?]*)$")
        whole = parts.is_valid().to_numpy(zero_copy_only=False)
        number, bodies = codes(pc.struct_field(parts.filter(parts.is_valid()), [0]))
        after, tails = codes(pc.struct_field(parts.filter(parts.is_valid()), [1]))
        tails = [b"" if not t else self.of_pieces([t])[0] for t in tails]
        found = self.of_pieces(bodies)
        found = [found[i] + tails[j] if tails[j] else found[i] for i, j in zip(number.tolist(), after.tolist(), strict=True)]
        if whole.all():
            return found
        rest = chunks.filter(pa.array(~whole)).to_pylist()
        cut = [WORD_PIECE.findall(c.lower()) if simple(c) else None for c in rest]
        flat = iter(self.of_pieces([p for pieces in cut if pieces for p in pieces]))
        odd = iter([x.tobytes() for x in self.plain([c for c, pieces in zip(rest, cut, strict=True) if pieces is None])])
        others = iter([next(odd) if pieces is None else b"".join([next(flat) for _ in pieces]) for pieces in cut])
        found = iter(found)
        return [next(found if x else others) for x in whole.tolist()]

    def encode(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of all texts one after another, and each text's number of ids."""
        text = pc.fill_null(text, "")
        # the library lower-cases too; doing it first only makes fewer words distinct
        text = pc.if_else(pc.match_substring_regex(text, r"[^\x00-\x{ff}]|<\|"), text, pc.utf8_lower(text))
        words, counts = split_words(text)
        number, distinct = coded(words)
        found = self.of_chunks(distinct)
        pool = np.frombuffer(b"".join(found), dtype=self.dtype)
        sizes = np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // self.dtype.itemsize
        first = np.cumsum(sizes) - sizes
        each = sizes[number]
        ends = np.cumsum(each)
        ids = pool[np.repeat(first[number] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)]
        bounds = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])]
        return ids, np.diff(bounds)


class ByteBpe:
    """Counts for a byte-level tokenizer that keeps white space (byte_bpe_50k.json)."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.line_end = self.library.token_to_id("\u010a")
        self.known = Memory()

    def plain(self, strings: list[str]) -> list[int]:
        return [len(x.ids) for x in self.library.encode_batch_fast(strings, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> None:
        alone = [p for p in pieces if not p.strip() or "\n" in p]
        self.known.update(zip(alone, self.plain(alone), strict=True))
        rest = [p for p in pieces if p.strip() and "\n" not in p]
        groups = [rest[i : i + JOINED] for i in range(0, len(rest), JOINED)]
        for group, x in zip(groups, self.library.encode_batch_fast(["\n".join(g) for g in groups], add_special_tokens=False), strict=True):
            ends = np.flatnonzero(np.array(x.ids) == self.line_end)
            each = (np.diff(np.concatenate([[-1], ends, [len(x.ids)]])) - 1).tolist() if len(ends) == len(group) - 1 else self.plain(group)
            self.known.update(zip(group, each, strict=True))

    def of_pieces(self, pieces: list[str]) -> list[int]:
        known = self.known
        found = list(map(known.get, pieces))
        missing = [p for p, x in zip(pieces, found, strict=True) if x is None]
        if missing:
            if known.full(len(missing)):
                missing = pieces
            self.learn(list(dict.fromkeys(missing)))
            found = [known[p] for p in pieces]
        return found

    def of_chunks(self, chunks: pa.Array) -> np.ndarray:
        parts = pc.extract_regex(chunks, f"^(?P<body> ?[{LETTER}]+)(?P<tail>[.,;:!?]*)$")
        whole = parts.is_valid()
        out = np.zeros(len(chunks), dtype=np.int64)
        at = whole.to_numpy(zero_copy_only=False)
        parts = parts.filter(whole)
        for field in (0, 1):
            number, pieces = codes(pc.struct_field(parts, [field]))
            known = np.array([0 if not p else n for p, n in zip(pieces, self.of_pieces([p or "." for p in pieces]), strict=True)], dtype=np.int64)
            out[at] += known[number]
        rest = chunks.filter(pc.invert(whole)).to_pylist()
        cut = [BYTE_PIECE.findall(c) if simple(c) else None for c in rest]
        flat = iter(self.of_pieces([p for pieces in cut if pieces for p in pieces]))
        odd = iter(self.plain([c for c, pieces in zip(rest, cut, strict=True) if pieces is None]))
        out[~at] = [next(odd) if pieces is None else sum([next(flat) for _ in pieces]) for pieces in cut]
        return out

    def count(self, text: pa.Array) -> np.ndarray:
        """Each text's number of ids."""
        text = pc.fill_null(text, "")
        odd = pc.match_substring_regex(text, SPACE_BESIDE_SPACE).to_numpy(zero_copy_only=False)
        out = np.zeros(len(text), dtype=np.int64)
        for row in np.flatnonzero(odd):
            out[row] = self.of_chunks(pa.array(CHUNK.findall(text[int(row)].as_py()), pa.string())).sum()
        even = np.flatnonzero(~odd)
        if len(even):
            lists = pc.split_pattern(text.take(pa.array(even)), " ")
            sizes = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
            number, distinct = coded(lists.flatten())
            first = np.cumsum(sizes) - sizes
            starts, where = np.unique(number[first], return_inverse=True)
            spaced = self.of_chunks(pc.binary_join_element_wise("", distinct, " "))[number]
            spaced[first] = self.of_chunks(distinct.take(pa.array(starts)))[where]
            out[even] = np.add.reduceat(spaced, first)
        return out


@functools.lru_cache(maxsize=4)
def word_bpe(path: str) -> WordBpe:
    return WordBpe(path)


@functools.lru_cache(maxsize=4)
def byte_bpe(path: str) -> ByteBpe:
    return ByteBpe(path)
