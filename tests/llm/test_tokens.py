"""Token counts, byte-level BPE and packing against the libraries themselves."""

import hashlib
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from tokenizers import Tokenizer

from orderflow.llm import tokenizers
from orderflow.llm.batches import even_batches, safe_parts
from orderflow.llm.byte_bpe import ByteBpe, bpe_decode, bpe_digests, bpe_encode
from orderflow.llm.packing import pack_documents
from orderflow.llm.token_counts import token_counts

JSON = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

TEXTS = [
    None,
    "",
    " ",
    "plain words, and  two blanks \n\n then   \t lines\r\n  ",
    "<|endoftext|> a <|endoftext|>b  <|endoftext|>\n c<|endoftext|>",
    "it's we'll 12,345.67 --- éèê über straße ñandú 漢字かな 한국어 \U0001f600\U0001f468‍\U0001f469",
    "no break  wide　 ideographic\x1c \x1d!\x1e! \x85next   line ᠎",
    "a" * 3000 + "b" * 17,
    "x" + " " * 300 + "y" + "\n" * 90,
    "ab" * 800 + " " + "0123456789" * 60,
    "thththththe onononon " * 50,
    "".join(map(chr, range(1, 0x250))),
    "é combining ̀́ marks",
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, f"src{i % 2}", 9) for i, t in enumerate(TEXTS)] + [(None, "null id", None, None), (3, TEXTS[3], "again", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, ids int").repartition(2)


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


def encoding():
    ranks = tokenizers.read_ranks(open(RANKS, "rb").read())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("table", ["docs", "real"])
def test_counts_are_those_of_the_library(table, request):
    rows = request.getfixturevalue(table)
    library = Tokenizer.from_file(JSON)
    got = sorted(map(tuple, token_counts(rows, JSON).collect()), key=str)
    want = []
    for row in rows.select("doc_id", "text").collect():
        n = len(library.encode(row.text or "", add_special_tokens=False).ids)
        want.append((row.doc_id, len((row.text or "").encode()), n, n > 512))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.tiktoken"])
def test_counts_of_other_tokenizers(spark, name):
    rows = spark.createDataFrame([(1, "Some Words  here"), (2, None)], "doc_id long, text string")
    path = public_tokenizers.path(name)
    want = len(tokenizers.batch_ids("." + name.rsplit(".")[-1], open(path, "rb").read())(["Some Words  here"])[0])
    assert {r.doc_id: r.n_tokens for r in token_counts(rows, path).collect()} == {1: want, 2: 0}


def test_long_texts_are_cut_safely():
    text = "one two  three\n" * 400 + "x" * 900 + " end"
    parts = list(safe_parts(text, 100))
    assert "".join(parts) == text and len(parts) > 30
    library = Tokenizer.from_file(JSON)
    assert sum(len(library.encode(p).ids) for p in parts) == len(library.encode(text).ids)
    assert list(safe_parts("y" * 500, 100)) == ["y" * 500]
    import pyarrow as pa

    batches = list(even_batches(pa.array(["a" * 60, None, "b" * 60, "c" * 200]), 100))
    assert [[row for row, _ in b] for b in batches] == [[0, 1], [2], [3]]


@pytest.mark.parametrize("table", ["docs", "real"])
def test_bpe_is_that_of_the_library(table, request):
    rows, library = request.getfixturevalue(table), encoding()
    got = sorted(map(tuple, bpe_digests(rows, RANKS).collect()), key=str)
    want = []
    for row in rows.select("doc_id", "text").collect():
        ids = library.encode_ordinary(row.text or "")
        digests = [hashlib.sha256(x).hexdigest() for x in (",".join(map(str, ids)).encode(), (row.text or "").encode())]
        want.append((row.doc_id, len(ids), *digests))
    assert got == sorted(want, key=str)


def test_bpe_of_every_code_point():
    bpe, library = ByteBpe(tokenizers.read_ranks(open(RANKS, "rb").read()), public_tokenizers.PATTERN), encoding()
    points = [chr(c) for c in range(0x11000) if not 0xD800 <= c < 0xE000]
    for first in range(0, len(points), 64):
        text = " x".join(points[first : first + 64]) + "".join(points[first : first + 64])
        assert bpe.encode(text) == library.encode_ordinary(text), hex(first)


def test_bpe_encode_and_decode(docs):
    encoded = bpe_encode(docs, RANKS)
    decoded = {(r.doc_id, bytes(r.decoded)) for r in bpe_decode(encoded, RANKS).collect()}
    assert decoded == {(r.doc_id, (r.text or "").encode()) for r in docs.collect()}


def test_empty_tables(docs):
    empty = docs.where("doc_id < 0")
    for result in (token_counts(empty, JSON), bpe_digests(empty, RANKS), bpe_encode(empty, RANKS), pack_documents(empty, JSON)):
        assert result.count() == 0


@pytest.mark.parametrize("table", ["docs", "real"])
def test_packing_places_each_id_once(table, request):
    rows, library = request.getfixturevalue(table), Tokenizer.from_file(JSON)
    pieces = pack_documents(rows, JSON, with_ids=True).collect()
    want = sorted(
        (str(r.doc_id), *library.encode(r.text or "", add_special_tokens=False).ids, 1) for r in rows.select("doc_id", "text").collect()
    )
    by_doc: dict = {}
    for p in pieces:
        assert p.length == len(p.ids) > 0
        assert p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
        by_doc.setdefault(p.doc_id, []).append(p)
    got = []
    for doc_id, own in by_doc.items():
        total, copies = own[0].doc_tokens, 2 if table == "docs" and doc_id == 3 else 1
        assert sum(p.length for p in own) == total * copies
        for k in range(copies):
            ids, at = [], 0
            for p in sorted(own, key=lambda p: p.start)[k::copies] if copies > 1 else sorted(own, key=lambda p: p.start):
                assert p.start == at
                ids += p.ids
                at += p.length
            got.append((str(doc_id), *ids))
    assert sorted(got) == want
    sequences: dict = {}
    for p in pieces:
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
    short = 0
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at == 2048 or at & (at - 1) == 0
        short += at != 2048
    assert short <= 11 * rows.rdd.getNumPartitions()


def test_a_full_memo_forgets_and_learns_again():
    from orderflow.llm.piece_memo import PieceMemo

    asked: list[str] = []
    memo = PieceMemo(lambda pieces: (asked.extend(pieces), [len(p) for p in pieces])[1], entries=8)
    for n in range(30):
        assert memo.split_and_encode([f"common word{n} other{n}", "common"]) == [[6, len(f" word{n}"), len(f" other{n}")], [6]]
    assert asked.count("common") == 1 and len(asked) == 61
    assert memo.split_and_encode(["word0 " + "x" * 99]) == [[5, 100]]


def test_packing_balances_cost():
    from orderflow.llm.packing import Piece, cost, fill

    rng = np.random.default_rng(1)
    pieces = [Piece(i, b"", 0, int(n)) for i, n in enumerate(rng.integers(1, 900, 4000))]
    full, left = fill(pieces, 2048)
    costs = [sum(cost(p.length) for p in s) for s in full]
    in_order = [pieces[i : i + 5] for i in range(0, 4000, 5)]
    unbalanced = [sum(cost(p.length) for p in s) for s in in_order]
    assert sum(p.length for p in left) < 2048
    assert np.std(costs) < 0.35 * np.std(unbalanced)
    assert max(costs) < 1.5 * np.mean(costs)


def test_pieces_are_those_of_the_plain_patterns():
    import random
    import re
    import sys

    from orderflow.llm import piece_memo

    rare = re.compile(r"[^\S \n\t\r]")
    assert all(piece_memo.has_rare_blank(f"a{c}b") == bool(rare.search(c)) for c in map(chr, range(sys.maxunicode + 1)))
    plain = re.compile(r"\s*[^\s,.;:!?]++(?<=[^\W_])(?=[,.;:!?])|\s*\S+|\s+")
    draw = random.Random(3)
    for _ in range(20_000):
        text = "".join(draw.choices(" \n\t\r.,;:!?_ab1é語-'", k=draw.randrange(30)))
        assert piece_memo.pieces(text) == plain.findall(text)
