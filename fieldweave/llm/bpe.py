"""BPE encoding and decoding: batched merge rounds over the symbols of many words."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fieldweave.llm.common import tidy


def byte_characters() -> list[str]:
    """The character that stands for each byte in vocabularies on bytes: printable ones for themselves, the rest in
    order from code point 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in shown)}
    return [hidden.get(b, chr(b)) for b in range(256)]


@dataclass(frozen=True)
class Vocabulary:
    """A vocabulary on bytes with word ends: its tokens by id, and its merges as sorted pair keys.

    A pair (a, b) has the key ``a * size + b``; ``ranks`` and ``results`` belong to the keys in order.
    """

    tokens: tuple[str, ...]
    plain: np.ndarray  # byte -> id
    final: np.ndarray  # last byte of a word -> id
    keys: np.ndarray
    ranks: np.ndarray
    results: np.ndarray
    split: str
    specials: dict[str, int]

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        """From a tokenizer's JSON file with the steps that this module knows; others are refused."""
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        steps = [s["type"] for s in spec["normalizer"]["normalizers"]]
        split, on_bytes = spec["pre_tokenizer"]["pretokenizers"]
        known = steps == ["NFC", "Replace", "Lowercase"] and split["type"] == "Split" and split["invert"] and split["behavior"] == "Removed"
        model = spec["model"]
        if not known or on_bytes["type"] != "ByteLevel" or on_bytes["use_regex"] or on_bytes["add_prefix_space"] or model["type"] != "BPE":
            raise ValueError(f"{path}: not a BPE of bytes with word ends, lower case and white space dropped")
        ids, end = model["vocab"], model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        by_id = {i: t for t, i in {**ids, **specials}.items()}
        size = len(by_id)
        keys = np.array([ids[a] * size + ids[b] for a, b in merges], np.int64)
        order = np.argsort(keys, kind="stable")
        return cls(
            tokens=tuple(by_id[i] for i in range(size)),
            plain=np.array([ids[c] for c in byte_characters()], np.int32),
            final=np.array([ids[c + end] for c in byte_characters()], np.int32),
            keys=keys[order],
            ranks=np.arange(len(merges), dtype=np.int32)[order],
            results=np.array([ids[a + b] for a, b in merges], np.int32)[order],
            split=split["pattern"]["Regex"],
            specials=specials,
        )


def encode_words(words: list[bytes], vocabulary: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all words in one flat array, and the bounds of each word in it.

    Pairs of neighbours are found by binary search over the sorted pair keys. Each round takes the lowest rank in each
    word, merges the pairs of that rank from left to right, and looks up the pairs that are new; words without a pair
    are done.
    """
    lengths = np.array([len(w) for w in words], np.int64)
    flat = np.frombuffer(b"".join(words), np.uint8)
    symbols = vocabulary.plain[flat]
    ends = np.cumsum(lengths) - 1
    symbols[ends] = vocabulary.final[flat[ends]]
    size, none = len(vocabulary.tokens), np.int32(2**31 - 1)
    word = np.repeat(np.arange(len(words)), lengths)
    pair = np.full(len(symbols), -1)  # of each symbol and the next: the place in the keys, or -1

    def look_up(at: np.ndarray) -> None:
        keys = symbols[at].astype(np.int64) * size + symbols[at + 1]
        found = np.minimum(np.searchsorted(vocabulary.keys, keys), len(vocabulary.keys) - 1)
        pair[at] = np.where((vocabulary.keys[found] == keys) & (word[at] == word[at + 1]), found, -1)

    look_up(np.arange(len(symbols) - 1))
    done_symbols, done_words = [], []
    while len(symbols):
        ranks = np.where(pair >= 0, vocabulary.ranks[pair], none)
        starts = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        counts = np.diff(np.concatenate([starts, [len(symbols)]]))
        lowest = np.repeat(np.minimum.reduceat(ranks, starts), counts)
        over = lowest == none
        if over.any():
            done_symbols.append(symbols[over])
            done_words.append(word[over])
        at = np.flatnonzero((ranks == lowest) & ~over)
        # Of pairs that overlap (a a a), every second one from the left of its run.
        run = np.cumsum(np.diff(at, prepend=-2) != 1)
        at = at[(np.arange(len(at)) - np.searchsorted(run, run)) % 2 == 0]
        symbols = symbols.copy()
        symbols[at] = vocabulary.results[pair[at]]
        keep = ~over
        keep[at + 1] = False
        place = np.cumsum(keep) - 1
        symbols, word, pair = symbols[keep], word[keep], pair[keep]
        new = place[at]
        before = new[new > 0] - 1
        look_up(np.concatenate([before, new[new < len(symbols) - 1]]))
        if len(pair):
            pair[-1] = -1
    word, symbols = np.concatenate(done_words), np.concatenate(done_symbols)
    order = np.argsort(word, kind="stable")
    return symbols[order], np.concatenate([[0], np.cumsum(np.bincount(word, minlength=len(words)))])


#: Signs that Python takes for white space and the vocabulary's pattern does not. Fixed values.
_NO_SPACE = regex.compile("[\x1c-\x1f]")


class _Numbers(dict):
    """Numbers keys in the order in which they are first asked for, and lists those in ``new``."""

    def __init__(self, known: dict[str, int]):
        super().__init__(known)
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        self.new.append(key)
        self[key] = number = len(self)
        return number


class Encoder:
    """Encodes texts. No word reaches over white space, so texts are cut there, and pieces met before are looked up, in
    a store that begins anew beyond ``max_pieces``."""

    def __init__(self, vocabulary: Vocabulary, max_pieces: int = 250_000):
        self.vocabulary, self.max_pieces = vocabulary, max_pieces
        self.pattern = regex.compile(vocabulary.split)
        self.special = regex.compile("(" + "|".join(map(regex.escape, vocabulary.specials)) + ")")
        self.reset()

    def reset(self) -> None:
        # Special tokens go by keys with a space, which no piece has.
        special = list(self.vocabulary.specials.items())
        self.known = _Numbers({f" {name}": i for i, (name, _) in enumerate(special)})
        self.ids = np.array([i for _, i in special], np.int32)
        self.bounds = np.arange(len(special) + 1)

    def pieces(self, text: str) -> list[str]:
        """Normalised pieces between white space, and special tokens."""
        out: list[str] = []
        for part in self.special.split(text) if "<|" in text else (text,):
            if part in self.vocabulary.specials:
                out.append(f" {part}")
                continue
            part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
            out += self.pattern.findall(part) if _NO_SPACE.search(part) else part.split()
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of the texts and their bounds."""
        if len(self.known) > self.max_pieces:
            self.reset()
        per_text = [self.pieces(t) for t in texts]
        flat = list(chain.from_iterable(per_text))
        rows = np.fromiter(map(self.known.__getitem__, flat), np.int64, len(flat))
        if self.known.new:
            words = [[p] if p.isalpha() else self.pattern.findall(p) for p in self.known.new]
            self.known.new.clear()
            some = [w.encode() for found in words for w in found]
            ids, bounds = encode_words(some, self.vocabulary) if some else (self.ids[:0], np.zeros(1, np.int64))
            ends = bounds[np.cumsum([len(found) for found in words])]
            self.bounds = np.concatenate([self.bounds, ends + self.bounds[-1]])
            self.ids = np.concatenate([self.ids, ids])
        starts, lengths = self.bounds[rows], self.bounds[rows + 1] - self.bounds[rows]
        before = np.concatenate([[0], np.cumsum(lengths)])
        out = self.ids[np.repeat(starts - before[:-1], lengths) + np.arange(before[-1])]
        return out, before[np.concatenate([[0], np.cumsum([len(p) for p in per_text])])]


#: Texts that are encoded or decoded at once: so many bytes or ids at most, one text at least.
CHUNK = 1_000_000


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Starts and lengths of slices of about CHUNK each."""
    after = np.concatenate([[0], np.cumsum(sizes)])
    at = 0
    while at < len(sizes):
        end = max(at + 1, int(np.searchsorted(after, after[at] + CHUNK, side="right")) - 1)
        yield at, end - at
        at = end


def _added(frame: DataFrame, name: str, kind: T.DataType) -> tuple[DataFrame, T.StructType]:
    frame = frame.drop(name)
    return frame, T.StructType([*frame.schema, T.StructField(name, kind)])


class Tokenizer:
    """Adds columns of ids to texts and of texts to ids, in place of columns of that name.

    Null and empty texts have no ids; no or null ids give an empty text. Texts of any length are encoded whole. Special
    tokens that stand in a text are encoded as such. All rows and other columns stay as they are.
    """

    def __init__(self, path: str):
        #: Goes to the workers with the functions; it does not grow with the data.
        self.vocabulary = Vocabulary.load(path)

    def encode(self, docs: DataFrame, text: str = "text", ids: str = "ids") -> DataFrame:
        vocabulary = self.vocabulary
        docs, schema = _added(docs, ids, T.ArrayType(T.IntegerType()))

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            encoder = Encoder(vocabulary)
            for batch in batches:
                texts = pc.fill_null(batch[text], "")
                for at, n in _slices(pc.binary_length(texts).to_numpy()):
                    flat, bounds = encoder.encode(texts.slice(at, n).to_pylist())
                    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(flat, pa.int32()))
                    yield pa.RecordBatch.from_arrays([*batch.slice(at, n).columns, lists], schema.names)

        return docs.mapInArrow(tidy(run), schema)

    def decode(self, rows: DataFrame, ids: str = "ids", text: str = "decoded") -> DataFrame:
        """The tokens joined by one space, as a tokenizer without a decoder gives them."""
        vocabulary = self.vocabulary
        rows, schema = _added(rows, text, T.StringType())

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tokens = pa.array(vocabulary.tokens, pa.string())
            for batch in batches:
                for at, n in _slices(pc.fill_null(pc.list_value_length(batch[ids]), 0).to_numpy()):
                    part = batch.slice(at, n)
                    own = part[ids]
                    lengths = pc.fill_null(pc.list_value_length(own), 0).to_numpy()
                    bounds = pa.array(np.concatenate([[0], np.cumsum(lengths)]), pa.int32())
                    joined = pc.binary_join(pa.ListArray.from_arrays(bounds, tokens.take(own.flatten())), " ")
                    yield pa.RecordBatch.from_arrays([*part.columns, joined], schema.names)

        return rows.mapInArrow(tidy(run), schema)
