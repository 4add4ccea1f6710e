import hashlib
import json
import random

import numpy as np
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st
from texts import ODD, empty, odd
from tokenizers import Tokenizer

from skylattice.llm import bpe
from skylattice.llm.queries import op2_bpe, vocabulary

PATH = vocabulary()
PIECES = [
    "a", "B", "é", "é", "İ", "ß", "ΑΣ", "ς", "1", "²", "½", "中", "😀", " ", "\u0085", " ", "​",
    "\n", "\t", "\x1c", "\x00", "'s", "'LL", "'", "<|endoftext|>", "<|startoftext|>", "<|", "</w>", "</", "!",
    "﻿", "ﬁ", "Ǆ", "-", "the", "ing", "ẞ", "Å", "ａ", "힣", "ª", "İ", "ı",
]


LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()


@pytest.fixture
def library():
    return LIBRARY


def same(library, text):
    coder = bpe.codec(PATH)
    ids = np.frombuffer(coder.encode(text), np.int32).tolist()
    assert ids == library.encode(text, add_special_tokens=False).ids
    assert coder.decode(ids) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=14).map("".join) | st.text(max_size=30))
def test_any_text(text):
    same(LIBRARY, text)


def test_every_character_of_the_lower_planes(library):
    for c in [*range(0, 0x3000, 3), *range(0x3000, 0xD800, 29), *range(0x1F000, 0x1FB00, 7)]:
        same(library, f"a{chr(c)}b {chr(c) * 2}1{chr(c)}")


def test_small_tables_change_nothing(library, monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    monkeypatch.setattr(bpe, "LONGEST", 4)
    draw = random.Random(2)
    for _ in range(200):
        same(library, "".join(draw.choice(PIECES) for _ in range(20)))


def test_cuts_are_where_no_token_reaches(library):
    coder = bpe.codec(PATH)
    bodies = {t.removesuffix("</w>") for t in library.get_vocab()}
    for word in ("zxqjkvbn", "ãĥ¼", "abc"):
        fragments = coder.cut(word)
        assert "".join(fragments) == word
        for a, b in zip(fragments[:-1], fragments[1:], strict=True):
            assert not any(a[-1] + b[0] in body for body in bodies)


def test_odd_rows(spark, library):
    coded = bpe.decode(bpe.encode(odd(spark), PATH), PATH)
    both = bpe.encode(odd(spark), PATH, back=True)
    assert sorted(map(str, both.collect())) == sorted(map(str, coded.collect()))
    rows = coded.collect()
    assert len(rows) == len(ODD)
    assert coded.columns.count("ids") == 1 and "size" in coded.columns
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert (r.ids, r.decoded) == (ids, library.decode(ids, skip_special_tokens=False))
    assert bpe.encode(empty(spark), PATH).collect() == []


def test_documents(spark, library):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in op2_bpe(spark, SF).collect():
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@pytest.mark.parametrize(
    ("step", "value"),
    [
        ("decoder", {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}),
        ("normalizer", {"type": "NFC"}),
        ("post_processor", {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": False, "use_regex": True}),
        ("pre_tokenizer", {"type": "Whitespace"}),
    ],
)
def test_files_with_other_steps_are_refused(tmp_path, step, value):
    with open(PATH, encoding="utf-8") as f:
        spec = json.load(f)
    other = tmp_path / "other.json"
    other.write_text(json.dumps(spec | {step: value}), encoding="utf-8")
    with pytest.raises(ValueError, match=step):
        bpe.Codec(str(other))
