"""Byte-level BPE ids through the ``tokenizers`` library, with caches of pieces.

The pre-tokenizer of a byte-level BPE cuts a text into pieces that are encoded
apart from one another, so the ids of a text are those of its pieces. Pieces
repeat far more often than texts do: caching their ids saves most of the work.
Every id comes from the library. A vocabulary file of another kind (another
pre-tokenizer, a normalizer, added tokens in another form) is encoded by the
library alone.
"""

from __future__ import annotations

import functools
import json
import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: The pre-tokenizer's pattern of the byte-level vocabulary.
PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
#: Texts that are not cut at single spaces: special tokens' marks, spaces beside other white space, and characters that libraries class differently.
UNEVEN = r"<\||  | \n|\n |^ | $|[\t\r\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: Most entries of each cache; a full cache is emptied.
MOST = 800_000
#: Marks that often end a word; after a word of letters they are a piece of their own.
MARKS = ".,;:!?"
#: Texts that are encoded in one call, in bytes.
CALL_BYTES = 8_000_000
#: Letters below this code point have the same class in every library's tables.
PLAIN = "\u0250"


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    out, spare = {}, 256
    for b in range(256):
        if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174:
            out[b] = chr(b)
        else:
            out[b] = chr(spare)
            spare += 1
    return out


class _Pieces(dict):
    """Piece of the pre-tokenizer to its ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, model):
        super().__init__()
        self.model, self.letters = model, byte_letters()
        self.space = self.letters[32]

    def __missing__(self, piece: str) -> bytes:
        if not piece:
            return b""
        if len(self) >= MOST:
            self.clear()
        plain = piece.replace(" ", self.space) if piece.isascii() and piece.strip().isalpha() else piece.encode().decode("latin-1").translate(self.letters)
        ids = self[piece] = array("I", [x.id for x in self.model.tokenize(plain)]).tobytes()
        return ids


class Encoder:
    """``ids(text)``: the ids of a whole text, as ``encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pieces = _Pieces(self.tokenizer.model)
        told = json.loads(self.tokenizer.to_str())
        cutter = told.get("pre_tokenizer") or {}
        #: Whether texts may be cut by PIECE: what the file says of itself is what that pattern stands for.
        self.plain = (
            told["model"]["type"] == "BPE" and not told["model"].get("ignore_merges") and told.get("normalizer") is None and cutter.get("type") == "ByteLevel"
            and not cutter.get("add_prefix_space") and cutter.get("use_regex", True) and all(t["content"].startswith("<|") for t in told.get("added_tokens") or [])
        )

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def cut(self, text: str) -> bytes:
        if not text.isascii() and max(text) >= PLAIN:
            return self.whole(text)
        return b"".join(map(self.pieces.__getitem__, PIECE.findall(text)))

    def ids(self, text: str | None) -> bytes:
        """The ids of one text, by way of ``encode_many``."""
        return self.encode_many(pa.array([text], pa.string()))[0].tobytes()

    def encode_many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each text has; null is empty.

        Words are looked up once for all texts of the call; ids are then gathered by word.
        """
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.plain:
            own = [np.frombuffer(self.whole(t), "<u4") for t in listed(texts)]
            return np.concatenate([np.zeros(0, np.uint32), *own]), np.array([len(x) for x in own], np.int64)
        uneven = pc.match_substring_regex(texts, pattern=UNEVEN).to_numpy(zero_copy_only=False)
        if uneven.any():
            flat, counts = self._even(texts.filter(pa.array(~uneven)))
            n = np.zeros(len(texts), np.int64)
            n[~uneven] = counts
            parts = np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else []
            out, k = [], 0
            for i, odd in enumerate(uneven):
                if odd:
                    text = texts[i].as_py()
                    own = np.frombuffer(self.whole(text) if "<|" in text or ODD.search(text) else self.cut(text), "<u4")
                    n[i] = len(own)
                else:
                    own, k = parts[k], k + 1
                out.append(own)
            return np.concatenate(out), n
        return self._even(texts)

    def _even(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if not len(texts):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        split = pc.split_pattern(texts, " ")
        ends = split.offsets.to_numpy().astype(np.int64)
        coded = split.values.slice(ends[0], ends[-1] - ends[0]).dictionary_encode()
        ends -= ends[0]
        firsts = pc.dictionary_encode(coded.take(pa.array(ends[:-1])).dictionary_decode())
        words, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        codes[ends[:-1]] = firsts.indices.to_numpy(zero_copy_only=False) + np.int64(len(words))
        table = [*self._after_space(words), *map(self.cut, listed(firsts.dictionary))]
        size = np.fromiter(map(len, table), np.int64, len(table)) // 4
        ids = np.frombuffer(b"".join(table), "<u4")
        per_word = size[codes]
        total = np.cumsum(per_word)
        at = np.repeat((np.cumsum(size) - size)[codes] - (total - per_word), per_word)
        at += np.arange(len(at))
        before = np.concatenate([[0], total])
        return ids[at], np.diff(before[ends])

    def _after_space(self, words: pa.Array) -> list[bytes]:
        """Ids of each word with a space before it. Most words are letters, then marks: two pieces."""
        cores = pc.utf8_rtrim(words, MARKS)
        simple = pc.and_(pc.utf8_is_alpha(cores), pc.invert(pc.match_substring_regex(cores, pattern="[^\\x00-\\x{24f}]"))).to_numpy(zero_copy_only=False)
        core_of, texts = pc.dictionary_encode(cores), listed(words)
        core_ids = [b""] * len(core_of.dictionary)
        at = core_of.indices.to_numpy(zero_copy_only=False)
        used = np.zeros(len(core_ids), bool)
        used[at[simple]] = True
        pieces, names = self.pieces, listed(core_of.dictionary)
        for k in np.flatnonzero(used).tolist():
            core_ids[k] = pieces[" " + names[k]]
        marks = pc.utf8_length(words).to_numpy() - pc.utf8_length(cores).to_numpy()
        out = [core_ids[k] for k in at.tolist()]
        for k in np.flatnonzero((marks > 0) & simple).tolist():
            out[k] += pieces[texts[k][-marks[k] :]]
        for k in np.flatnonzero(~simple).tolist():
            word, _, more = texts[k].partition("\n")
            core, next_core = word.rstrip(MARKS), more.rstrip(MARKS)
            if core.isalpha() and next_core.isalpha() and max(texts[k]) < PLAIN:
                out[k] = pieces[" " + core] + pieces[word[len(core) :]] + pieces["\n"] + pieces[next_core] + pieces[more[len(next_core) :]]
            else:
                out[k] = self.cut(" " + texts[k])
        return out


def listed(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each Python worker."""
    return Encoder(path)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches, in slices of at most about CALL_BYTES."""
    for b in batches:
        step = max(1, b.num_rows * CALL_BYTES // max(1, b.nbytes))
        for k in range(0, b.num_rows, step):
            yield b.slice(k, step)
