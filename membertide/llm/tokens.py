"""Token ids of whole texts from the tokenizers library, with a bounded cache of words."""

from __future__ import annotations

import json
import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: What a tokenizer file must ask for so that simple words can go to its BPE model directly: the
#: words are lower-cased and cut as the file's own steps would. Fixed values.
_LOWER_WORDS = {
    "normalizer": ["NFC", "Replace", "Lowercase"],
    "pattern": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+",
}
#: Printable ASCII and the letters of Latin-1: no combining marks, one byte-level form each.
_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
#: Letters with at most one sign behind them: two pieces at most.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)")
#: The pattern above, on lower-case text of those characters.
_PIECE = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class _Words(dict):
    """Ids of words, which are encoded when first asked for. Words that are too long are not kept."""

    def __init__(self, encode, longest: int):
        self.encode, self.longest, self.old = encode, longest, {}

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.encode(word)
            if len(word) > self.longest:
                return ids
        self[word] = ids
        return ids

    def aged(self, capacity: int) -> None:
        """Beyond ``capacity`` words begin a generation: what it does not use will go."""
        if len(self) > capacity:
            self.old = dict(self)
            self.clear()


class WordEncoder:
    """Encodes texts with a tokenizer that drops white space and never joins across it.

    Under that condition a text's ids are those of its words in turn, so each word is encoded once
    and looked up from then on. About ``capacity`` words are kept in each of two generations; what was
    not used during one generation goes.
    """

    def __init__(self, path: str, capacity: int = 450_000, longest: int = 64):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.capacity, self.longest = capacity, longest
        self.words = _Words(self._word, longest)
        self.pieces: dict[str, bytes] = {}
        added = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(added) or "(?!)")
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        cuts = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.direct = steps == _LOWER_WORDS["normalizer"] and cuts[0].get("pattern") == {"Regex": _LOWER_WORDS["pattern"]}
        if not self.direct and not self._drops_white_space():
            raise ValueError("the tokenizer must drop white space and keep words apart")
        if self.direct:
            letters = [chr(c) for c in range(0xC0, 0x100)]
            self.bytes = str.maketrans({c: self.tokenizer.pre_tokenizer.pre_tokenize_str(c)[0][0] for c in letters})

    def _drops_white_space(self) -> bool:
        return self._library("ab \n ab ab") == 3 * self._library("ab")

    def _library(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            mapped = piece if piece.isascii() else piece.translate(self.bytes)
            ids = array("I", [t.id for t in self.model.tokenize(mapped)]).tobytes()
            if len(self.pieces) >= self.capacity:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def _word(self, word: bytes) -> bytes:
        if not self.direct or len(word) > self.longest:
            return self._library(word.decode())
        if word.isalpha():  # of bytes: ASCII letters alone
            return self._piece(word.lower().decode())
        text = word.decode()
        plain = _PLAIN.fullmatch(text)
        if plain:
            letters, sign = plain.groups()
            return self._piece(letters.lower()) + self._piece(sign) if sign else self._piece(letters.lower())
        if not _SIMPLE.fullmatch(text) or self.special.search(text):
            return self._library(text)
        return b"".join([self._piece(p) for p in _PIECE.findall(text.lower())])

    def flat(self, texts: pa.Array, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, each text's followed by ``end``, and where each text begins and ends.

        Arrow cuts the words and tells equal ones, so Python sees a word once per call.
        """
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        bounds = split.offsets.to_numpy().astype(np.int64)
        coded = split.flatten().dictionary_encode()
        joined = pc.binary_join(pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary), " ")[0].as_buffer()
        known = list(map(self.words.__getitem__, joined.to_pybytes().split(b" "))) if len(coded.dictionary) else []
        which = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        if end is not None:
            which = np.insert(which, bounds[1:], len(known))
            known.append(int(end).to_bytes(4, "little"))
            bounds = bounds + np.arange(len(bounds))
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        begins, every = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(known), "<u4")
        lengths = sizes[which]
        done = np.concatenate(([0], np.cumsum(lengths)))
        at = np.repeat(begins[which] - done[:-1], lengths) + np.arange(done[-1])
        self.words.aged(self.capacity)
        return every[at], done[bounds]

    def encode(self, texts: pa.Array | list[str | None], end: int | None = None) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers, then ``end``; null is empty."""
        ids, bounds = self.flat(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), end)
        raw, places = ids.tobytes(), (4 * bounds).tolist()
        return [raw[b:e] for b, e in zip(places, places[1:])]

    def counts(self, raws: list[bytes]) -> list[np.ndarray]:
        """Per text the number of ids of each of its words."""
        ids, out = self.words.__getitem__, []
        for raw in raws:
            found = list(map(ids, raw.split()))
            out.append(np.fromiter(map(len, found), np.int64, len(found)) // 4)
        self.words.aged(self.capacity)
        return out

    def count(self, raw: bytes) -> int:
        """The number of ids of a short text."""
        return sum(len(self.words.get(w) or self._word(w)) for w in raw.split()) // 4


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker process's encoder for this vocabulary, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
