"""Offset-preserving pieces against the library that owns the models."""

from __future__ import annotations

import hashlib
import random
import struct

import public_tokenizers
import pytest
import sentencepiece
from given import SMALL

from tillstream.llm import pieces, queries
from tillstream.llm.charmap import CharMap, Spec, _field, message

MODEL = "piece_bpe_32k.model"
ODD = "ab  　①ﬁé́Å\r\n\t½ｶﾞㄱ각각ß­​​한🙂▁ſİ\x00\x7f"
NASTY = [None, "", " ", "   a  b ", "▁a▁", "<s> </s> <unk> <0x41>", "\0", "a\0\0b", "🙂" * 50, "x" * 30_000, "é\n\n\té", " lead", "trail "]


def library():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(MODEL))


def odd_texts(n):
    rng = random.Random(11)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 16))) for _ in range(n)]


@pytest.mark.parametrize("rule", ["identity", "nfkc", "nmt_nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("said", [{}, {"remove_extra_whitespaces": False}, {"escape_whitespaces": False}])
def test_normalisation_and_sources_are_the_librarys(rule, said):
    tool = sentencepiece.SentencePieceNormalizer(rule_name=rule, **said)
    spec, _ = Spec.read(tool.serialized_model_proto())
    own = CharMap(spec)
    assert bool(spec.charsmap) == (rule != "identity")
    for text in odd_texts(1500):
        raw = text.encode()
        want, places = tool.normalize(text, with_offsets=True)
        found, source = own.normalise(raw)
        assert found.decode() == want
        assert len(source) == len(found) + 1
        at = [len(c.encode()) for c in want]
        begins = [sum(at[:i]) for i in range(len(at) + 1)]
        assert [len(raw[: source[b]].decode()) for b in begins] == list(places)


def with_charsmap(rule):
    """The public model with the compiled map of a rule in place of its own."""
    rules = next(v for n, _, v in message(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto()) if n == 3)
    with open(public_tokenizers.path(MODEL), "rb") as f:
        parts = [_field(n, v) for n, _, v in message(f.read()) if n != 3]
    return b"".join(parts) + _field(3, rules)


def spans_of(tool, text):
    """(id, start, end) in bytes, as the library's own record has them."""
    said = tool.encode_as_offset_mapping(text)
    size = lambda n: len(text[:n].encode())
    return [(i, size(a), size(b)) for i, (a, b) in zip(said["ids"], said["offsets"], strict=True)]


@pytest.mark.parametrize("rule", [None, "nmt_nfkc", "nfkc_cf"])
def test_spans_are_the_librarys(rule, tmp_path):
    file = public_tokenizers.path(MODEL)
    if rule:
        file = str(tmp_path / "mapped.model")
        with open(file, "wb") as f:
            f.write(with_charsmap(rule))
    tool = sentencepiece.SentencePieceProcessor(model_file=file)
    texts = [t for t in NASTY if t is not None] + odd_texts(800)
    ids, starts, ends = pieces.PieceEncoder(file).encode([t.encode() for t in texts])
    for text, i, a, b in zip(texts, ids, starts, ends, strict=True):
        assert list(zip(i[1:-1].tolist(), a[1:-1].tolist(), b[1:-1].tolist(), strict=True)) == spans_of(tool, text), text
        assert (i[0], a[0], b[0]) == (1, 0, 0) and (i[-1], a[-1], b[-1]) == (2, len(text.encode()), len(text.encode()))


def digests(tool, text):
    ids = tool.encode(text or "", add_bos=True, add_eos=True)
    packed = struct.pack(f"<{len(ids)}I", *ids)
    return len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(tool.decode(ids).encode()).hexdigest()


def test_op13_is_the_library_over_a_whole_table(spark, small_docs):
    tool = library()
    found = {r[0]: tuple(r[1:]) for r in queries.queries()["op13_offset_pieces"](spark, SMALL).collect()}
    assert found == {d: digests(tool, t) for d, t in small_docs}


def test_op13_on_nasty_rows(spark, make):
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(NASTY + odd_texts(50))] + [(3, "again", "", "", ""), (3, "again", "", "", "")]
    rows.append((None, "no id", "", "", ""))
    ddl = "doc_id long, text string, ids string, starts string, decoded string"
    found = queries.queries()["op13_offset_pieces"](spark, make(documents=(rows, ddl))).collect()
    tool = library()
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, found), key=key) == sorted(((r[0], *digests(tool, r[1])) for r in rows), key=key)
    assert queries.queries()["op13_offset_pieces"](spark, make(documents=([], ddl))).count() == 0


def test_pieces_tell_the_text_they_stand_for(spark):
    text = "Grüße  aus 🙂 dem All"
    row = pieces.encode_pieces(spark.createDataFrame([(1, text)], "doc_id long, text string"), MODEL).first()
    raw = text.encode()
    assert b"".join(raw[a:b] for a, b in zip(row.starts, row.ends, strict=True)) == raw
    assert all(b <= c for b, c in zip(row.ends, row.starts[1:], strict=False))
    assert library().decode(row.ids) == text
