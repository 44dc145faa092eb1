import random
import weakref
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from covenant.llm import common, packing
from tests.llm.corpora import documents, no_documents, texts

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def test_pieces_cover_every_document(spark, tokenizer):
    docs = documents(spark)
    found = packing.pack(docs, PATH).collect()
    wanted = [(i, tokenizer.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in texts()]
    # Repeated ids: pieces are told apart by what they hold.
    pieces = defaultdict(list)
    for r in found:
        assert len(r.ids) == r.length > 0
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32
        pieces[r.doc_id].append(r)
    for key in {i for i, _ in wanted}:
        own = Counter()
        for i, ids in wanted:
            if i == key:
                own.update((at, x, len(ids)) for at, x in enumerate(ids))
        assert own == Counter((r.start + n, x, r.doc_tokens) for r in pieces[key] for n, x in enumerate(r.ids))
    sequences = defaultdict(list)
    for r in found:
        sequences[r.sequence_id].append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY


def test_empty_table(spark):
    assert packing.pack(no_documents(spark), PATH, with_ids=False).collect() == []


def test_words_give_the_same_ids_as_whole_texts(tokenizer, monkeypatch):
    known = packing.Encoder(PATH)
    rng = random.Random(0)
    alphabet = "abcdeéüßÑ  \n\t.,'!?_-0123456789<|>=\x1c\x85 ²½ 漢😀"
    cases = ["", " ", "it's we'll  go\n\n now", "<|endoftext|> a_b __ _x", "x" * 3000, "a  b   c \n d"]
    cases += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    cases += ["".join(rng.choice("ab \n\t.1é") for _ in range(rng.randrange(1, 12))) for _ in range(3000)]
    cases += ["".join(rng.choice(alphabet[:45]) for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    wanted = [tokenizer.encode(text, add_special_tokens=False).ids for text in cases]
    for text, ids in zip(cases, wanted, strict=True):
        assert known.ids(text).tolist() == ids, repr(text)
    monkeypatch.setattr(packing, "REMEMBERED", 5)
    few = packing.Encoder(PATH)
    for at in range(0, len(cases), 7):
        assert [x.tolist() for x in few.batch(cases[at : at + 7])] == wanted[at : at + 7]


def test_words_stay_known_from_task_to_task(monkeypatch):
    first = packing.encoder(PATH).ids("many planted words, many").tolist()
    later = packing.encoder(PATH)
    monkeypatch.setattr(later, "tokenizer", None)  # nothing can be encoded anew
    assert later.ids("many planted words, many").tolist() == first


def test_what_a_stage_learnt_goes_with_it(monkeypatch):
    monkeypatch.setattr(common, "_stage", lambda: 1)
    known = packing.encoder(PATH)
    common.release_memory()
    assert packing.encoder(PATH) is known
    left = weakref.ref(known)
    del known
    # The worker goes on with a stage of another operator.
    monkeypatch.setattr(common, "_stage", lambda: 2)
    common.release_memory()
    assert left() is None


def test_words_in_use_outlive_the_others(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    known = packing.Encoder(PATH)
    for n in range(20):
        known.ids(f"common{' ' + chr(97 + n) * 3}")
    assert len(known.words) + len(known.words.old) <= 8
    monkeypatch.setattr(known, "tokenizer", None)
    assert len(known.ids("common"))


def test_an_added_token_is_that_token():
    # The fixed value is what the public vocabulary gives.
    assert packing.Encoder(PATH).ids("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]


def test_cuts():
    for n in range(1, 5000):
        lengths = packing.cut_lengths(n)
        assert sum(lengths) == n and all(0 < x <= packing.CAPACITY for x in lengths)
    # Bins of a class always take their number of pieces.
    for length in range(1, packing.CAPACITY + 1):
        assert (packing.CAPACITY // length) * length <= packing.CAPACITY


def test_little_padding():
    rng = random.Random(1)
    packer = packing.Packer(0, packing.CAPACITY)
    total = 0
    for doc in range(3000):
        n = int(rng.lognormvariate(6, 1)) + 1
        total += n
        packer.add(doc, np.zeros(n, "<u4"))
    packer.finish()
    assert sum(len(r[2]) for r in packer.rows) == total
    assert total / (packer.next * packing.CAPACITY) > 0.97
