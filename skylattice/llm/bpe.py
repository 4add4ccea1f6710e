"""Byte-pair encoding by forced-boundary splitting, and decoding.

A byte pair that occurs inside no token of the vocabulary can never be joined by a merge, so
between two such bytes a cut is certain. A blank is in no token, so a text is cut at blanks first;
what lies between falls into words, and each word is cut at such pairs. The fragments are encoded
independently and their ids concatenated, which gives the ids of the whole text. A fragment that
ends a word carries the word-end mark, the others do not. Fragments repeat far more often than
texts, so each task keeps the ids of those it has seen (tables of bounded size).

The vocabulary is a tokenizers JSON file, named by its path; special strings in a text become
their ids, as that library does it. A file whose normaliser, cutting, model or decoder differ from what
is done here is refused. Defined results: a null text is encoded as an empty one (no
ids, empty decoded text). Other columns, whatever their names, stay, except that input columns
named as an output column are replaced.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from operator import add

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from tokenizers import Tokenizer
from tokenizers.models import BPE

#: Words and fragments that a task remembers; the tables start anew beyond it, and with each task.
REMEMBERED = 100_000
#: Bytes of text in one batch of results.
OUT_BYTES = 2 << 20
#: The longest stretch without blanks that is remembered as such.
LONGEST = 64
#: Texts of these characters only are lower-cased and cut at blanks here; for them Python's rules
#: and the library's are the same. Any other text goes through the library's own steps.
PLAIN = re.compile(r"[\t\n\v\f\r\x20-\x7e\xa1-\u012f\u0131-\u024f]*")


class _Remembered(dict):
    """A table filled by a function, emptied when it holds too much."""

    def __init__(self, make) -> None:
        self.make = make

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[key] = self.make(key)
        return value


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where it prints, else the next from U+0100."""
    prints = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in prints]
    return [chr(b) if b in prints else chr(256 + hidden.index(b)) for b in range(256)]


#: Steps of a tokenizer file that :class:`Codec` follows (fixed values of the file format).
STEPS = {
    "decoder": None,
    "post_processor": None,
    "normalizer": {
        "type": "Sequence",
        "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}],
    },
}
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "byte_fallback": False, "ignore_merges": False}
SPLIT = {"type": "Split", "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
ADDED = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False}


def refuse_others(spec: dict, path: str) -> None:
    """Raise where a tokenizer file asks for steps that would give other ids or another text than here."""

    def differing(given: dict, wanted: dict, where: str) -> list[str]:
        return [f"{where}{name}" for name, value in wanted.items() if given.get(name, value) != value]

    cuts = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or []
    odd = [name for name, value in STEPS.items() if spec.get(name) != value]
    odd += differing(spec["model"], MODEL, "model.")
    if [c.get("type") for c in cuts] != ["Split", "ByteLevel"]:
        odd.append("pre_tokenizer")
    else:
        odd += differing(cuts[0], SPLIT, "pre_tokenizer.") + differing(cuts[1], BYTES, "pre_tokenizer.")
    odd += [f"added token {a['content']!r}" for a in spec["added_tokens"] if differing(a, ADDED, "") or not a["content"].startswith("<|")]
    if odd:
        raise ValueError(f"{path}: encoding here does not follow its {', '.join(odd)}")


class Codec:
    """Encoder and decoder of one vocabulary file, made once in each Python worker."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        refuse_others(spec, path)
        model = spec["model"]
        self.end = model["end_of_word_suffix"] or ""
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.final = self.tokenizer.model
        self.inner = BPE(vocab=model["vocab"], merges=merges, cache_capacity=0)
        self.letters = byte_letters()
        self.tokens = {i: t for t, i in model["vocab"].items()}
        self.special = {a["content"]: a["id"] for a in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.special.items()}
        self.specials = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)))
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.find = regex.compile(pattern).findall
        self.joined = self._pairs(model["vocab"])
        self.stretches = _Remembered(self._words)
        self.words = _Remembered(self._plain_word)
        self.mapped = _Remembered(self._mapped_word)
        self.fragments = _Remembered(self._fragment)
        self.names = [self.tokens.get(i, "") for i in range(max(self.tokens) + 1)]

    def _pairs(self, vocabulary: dict[str, int]) -> set[str]:
        """The byte pairs, as letters, that occur inside some token."""
        pairs: set[str] = set()
        for token in vocabulary:
            body = token.removesuffix(self.end) if self.end and token != self.end else token
            pairs.update(body[i : i + 2] for i in range(len(body) - 1))
        return pairs

    def cut(self, word: str) -> list[str]:
        """The fragments of a word (given as byte letters), cut where no token can reach across."""
        pairs = list(map(add, word, word[1:]))
        if self.joined.issuperset(pairs):
            return [word]
        cuts = [0, *[i for i, pair in enumerate(pairs, 1) if pair not in self.joined], len(word)]
        return [word[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _fragment(self, key: tuple[str, bool]) -> bytes:
        fragment, last = key
        model = self.final if last else self.inner
        return array("i", [t.id for t in model.tokenize(fragment)]).tobytes()

    def _mapped_word(self, word: str) -> bytes:
        *inner, last = self.cut(word)
        if not inner:
            return self._fragment((last, True))
        parts = [(f, False) for f in inner] + [(last, True)]
        return b"".join([self.fragments[p] if len(p[0]) <= LONGEST else self._fragment(p) for p in parts])

    def _plain_word(self, word: str) -> bytes:
        return self._mapped_word(word if word.isascii() else "".join(map(self.letters.__getitem__, word.encode())))

    def _words(self, stretch: str) -> bytes:
        return b"".join([self.words[w] if len(w) <= LONGEST else self._plain_word(w) for w in self.find(stretch)])

    def _text(self, text: str) -> bytes:
        """Ids of a text without special strings."""
        if PLAIN.fullmatch(text):
            stretches = text.lower().split()
            if max(map(len, stretches), default=0) <= LONGEST:
                return b"".join(map(self.stretches.__getitem__, stretches))
            return b"".join([self.stretches[s] if len(s) <= LONGEST else self._words(s) for s in stretches])
        normal = self.tokenizer.normalizer.normalize_str(text)
        pieces = self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)
        return b"".join([self.mapped[p] if len(p) <= 2 * LONGEST else self._mapped_word(p) for p, _ in pieces])

    def encode(self, text: str) -> bytes:
        """The ids as 32-bit integers."""
        parts, at = [], 0
        for found in self.specials.finditer(text) if "<|" in text else ():
            parts.append(self._text(text[at : found.start()]))
            parts.append(np.int32(self.special[found.group()]).tobytes())
            at = found.end()
        parts.append(self._text(text[at:]))
        return b"".join(parts)

    def forget(self) -> None:
        """Empty the tables: a worker lives longer than its task."""
        for table in (self.stretches, self.words, self.mapped, self.fragments):
            table.clear()
        pa.default_memory_pool().release_unused()

    def decode(self, ids: Iterable[int]) -> str:
        """The library's text of the ids: this vocabulary has no decoder, so tokens and blanks."""
        return " ".join(map(self.names.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def _with(docs: DataFrame, column: T.StructField) -> T.StructType:
    return T.StructType([*[f for f in docs.schema.fields if f.name != column.name], column])


def _slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``OUT_BYTES`` each."""
    start, held = 0, 0
    for i, size in enumerate(sizes):
        held += size
        if held >= OUT_BYTES:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


def encode(docs: DataFrame, path: str, text: str = "text", back: bool = False) -> DataFrame:
    """``docs`` with ``ids``, the token ids of the whole text, no tokens added, none cut off.

    ``back`` adds what :func:`decode` makes of the ids, in the same pass.
    """
    schema = _with(docs, T.StructField("ids", T.ArrayType(T.IntegerType(), False), False))
    names = schema.names[:-1]
    if back:
        names = [n for n in names if n != "decoded"]
        fields = [f for f in schema.fields if f.name != "decoded"]
        schema = T.StructType([*fields, T.StructField("decoded", T.StringType(), False)])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text))
            for a, b in _slices(pc.binary_length(texts).fill_null(0).to_pylist()):
                ids = [coder.encode(t or "") for t in texts.slice(a, b - a).to_pylist()]
                ends = np.cumsum([0, *[len(x) // 4 for x in ids]], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(ids), dtype=np.int32))
                kept = [batch.column(batch.schema.get_field_index(n)).slice(a, b - a) for n in names]
                columns = [*kept, pa.ListArray.from_arrays(pa.array(ends), values)]
                if back:
                    columns.append(pa.array([coder.decode(array("i", x)) for x in ids], pa.string()))
                yield pa.record_batch(columns, schema.names)
        coder.forget()

    return docs.mapInArrow(task, schema)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``; null ids give an empty text."""
    schema = _with(encoded, T.StructField("decoded", T.StringType(), False))
    names = schema.names[:-1]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = codec(path)
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("ids"))
            lengths = ids.value_lengths().fill_null(0).to_pylist()
            for a, b in _slices([8 * n for n in lengths]):
                texts = pa.array([coder.decode(x or []) for x in ids.slice(a, b - a).to_pylist()], pa.string())
                kept = [batch.column(batch.schema.get_field_index(n)).slice(a, b - a) for n in names]
                yield pa.record_batch([*kept, texts], schema.names)

    return encoded.mapInArrow(task, schema)
