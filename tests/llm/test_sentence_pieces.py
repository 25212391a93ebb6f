import hashlib
import random
import struct

import pytest

from scriptorium.llm import sentence_pieces
from scriptorium.llm.sentence_pieces import Model

P, library = pytest.importorskip("public_tokenizers"), pytest.importorskip("sentencepiece")
PATH = P.path("piece_bpe_32k.model")
LETTERS = "aabeth  \n\t12²½Ⅷ一二é▁_　\x1c\x85\x00 \U0001f600.,#١ﬁ①Å"


@pytest.fixture(scope="module")
def both():
    return library.SentencePieceProcessor(model_file=PATH), Model(open(PATH, "rb").read())


def _texts(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(n)]


def _like(theirs, model, text):
    ids, ends, first = model.encode(text)
    want = theirs.encode(text, return_type="proto").pieces
    spans = list(zip([first, *ends.tolist()], ends.tolist()))
    same = ids.tolist() == [p.id for p in want], spans == [(p.begin, p.end) for p in want]
    assert same == (True, True), repr(text[:80])
    full = [model.begin, *ids.tolist(), model.end]
    assert model.decode(full) == theirs.decode(full)


def test_like_the_library(both):
    for t in [*_texts(2000), "a" * 30_000, " " * 999, "the quick brown fox " * 500, "<s> </s> <unk> <0x0A>", "▁▁a ▁", "x \n \n y", "  lead", "trail  ", "été" * 99]:
        _like(*both, t)


def test_parts_side_by_side_like_the_heap(both):
    _, model = both
    rng = random.Random(9)
    parts = ["".join(rng.choice("▁▁▁abethnio,.éé一aa") for _ in range(rng.randint(1, 40))) for _ in range(3000)] + ["▁" * n for n in range(1, 40)]
    for part, packed in zip(parts, model.side_by_side(parts)):
        assert packed is not None and packed == struct.pack(f"<{len(ids := model.plain(part))}I", *ids), part
    assert model.side_by_side(["a", "a漢\U0001f9ff", "b"])[1] is None and model.side_by_side(["a"])[0]


def test_ids_of_any_kind_are_decoded(both):
    theirs, model = both
    rng = random.Random(3)
    bytes_ = [k for k, kind in enumerate(model.kinds) if kind == sentence_pieces.BYTE]
    for _ in range(3000):
        ids = [rng.choice(bytes_) if rng.random() < 0.5 else rng.choice([0, 1, 2, 259, 28705, rng.randrange(32_000)]) for _ in range(rng.randint(0, 8))]
        assert model.decode(ids) == theirs.decode(ids), ids


def test_many_texts_like_one(both):
    _, model = both
    small = Model(open(PATH, "rb").read(), cached=10)
    texts = [*_texts(500, 4), "", "▁", "a" * 5000]
    for _ in range(2):
        for one, (ids, ends, first) in zip(map(model.encode, texts), small.encode_all(texts)):
            assert (one[0].tolist(), one[1].tolist(), one[2]) == (ids.tolist(), ends.tolist(), first)


def test_whole_texts_merge_like_parts(both):
    _, model = both
    whole = Model(open(PATH, "rb").read())
    whole.apart = False
    for t in _texts(300, 7):
        a, b = model.encode(t), whole.encode(t)
        assert a[0].tolist() == b[0].tolist() and a[1].tolist() == b[1].tolist()
    whole.parts = __import__("re").compile("(?s).+")
    for t in _texts(300, 8):
        assert model.encode(t)[0].tolist() == whole.encode(t)[0].tolist()


def _message(*fields):
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    return b"".join(varint(n << 3 | (2 if isinstance(v, bytes) else 0)) + (varint(len(v)) + v if isinstance(v, bytes) else varint(v)) for n, v in fields)


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("strip,dummy,suffix", [(1, 1, 0), (0, 1, 0), (1, 0, 0), (1, 1, 1)])
def test_maps_and_spaces_like_the_library(rule, strip, dummy, suffix):
    """The given pieces behind the library's own compiled maps."""
    made = library.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()
    blob = next(v for n, v in sentence_pieces._fields(dict(sentence_pieces._fields(made))[3]) if n == 2)
    given = list(sentence_pieces._fields(open(PATH, "rb").read()))
    trainer = dict(given)[2] + _message((24, suffix))
    raw = _message(*((1, v) for n, v in given if n == 1), (2, trainer), (3, _message((1, rule.encode()), (2, blob), (3, dummy), (4, strip), (5, 1))))
    theirs, model = library.SentencePieceProcessor(model_proto=raw), Model(raw)
    assert model.map.longest("ﬁn".encode(), 0) == ("fi", 3)
    for t in [*_texts(600, 5), "  ", "ＡＢ①  x ﬁ", "é Å", "Straße İ", "", "​ x", "ガｶﾞ"]:
        _like(theirs, model, t)


def test_other_models_raise():
    given = list(sentence_pieces._fields(open(PATH, "rb").read()))
    kind = _message((3, 1))
    with pytest.raises(ValueError, match="BPE"):
        Model(_message(*((1, v) for n, v in given if n == 1), (2, dict(given)[2] + kind), (3, dict(given)[3])))


def test_tables(spark, odd, odd_rows, nothing, both):
    theirs, model = both
    want = []
    for i, t, *_ in odd_rows:
        ids = theirs.encode(t or "", add_bos=True, add_eos=True)
        want.append((str(i), len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(theirs.decode(ids).encode()).hexdigest()))
    assert sorted((str(r[0]), *r[1:4]) for r in sentence_pieces.digests(odd, PATH).collect()) == sorted(want)
    coded = sentence_pieces.encode(odd, PATH)
    assert coded.columns == [*odd.columns, "ids", "ends"]
    for r in coded.collect():
        assert len(r.ids) == len(r.ends) and r.ends[-1] == len((r.text or "").encode()) and r.ends == sorted(r.ends) and r.ends[0] == 0
    back = sentence_pieces.decode(coded.select("doc_id", "ids"), PATH)
    assert sorted(r.text for r in back.collect()) == sorted(t or "" for _, t, *_ in odd_rows)
    assert sentence_pieces.digests(nothing, PATH).count() == 0 and sentence_pieces.encode(nothing, PATH).count() == 0
