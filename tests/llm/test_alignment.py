import bisect
import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_helpers import documents
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from corpusmill.llm import alignment, records
from corpusmill.llm.common import Stages

JSON, MODEL = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["▁ blank", "<|endoftext|> here <|endoftext|>", "<s> a </s> <unk> <0x41>", "  wide　space", "a" * 300 + " " * 70 + "b" * 33,
       "=" * 131 + "\n" + "-" * 97, "漢字かな交じり文 한국어 العربية", "🙂🙃👩‍👩‍👧 é́", "\x00 nul", "tab\tand\r\nline", "x" * 3000]


@pytest.fixture(scope="module")
def libraries():
    a, b = Tokenizer.from_file(JSON), sentencepiece.SentencePieceProcessor(model_file=MODEL)
    a.encode_special_tokens = True
    byte = {c: n for n, c in records.byte_letters().items()}
    spell_a = lambda i: bytes(byte[c] for c in a.id_to_token(i))
    spell_b = lambda i: bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
    return a, b, spell_a, spell_b


def brute(texts, libraries):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text, pair by pair."""
    a, b, spell_a, spell_b = libraries
    docs = []
    for t in texts:
        ids = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        spans = [np.cumsum([len(spell(i)) for i in own]).tolist() for own, spell in zip(ids, (spell_a, spell_b))]
        if t and not all(b"".join(map(spell, own)) == b" " + t.encode() for own, spell in zip(ids, (spell_a, spell_b))):
            ids, spans = ([], []), ([], [])
        cuts = sorted(set(spans[0]) & set(spans[1]))
        groups = [([], []) for _ in cuts]
        for side in (0, 1):
            for i, e in zip(ids[side], spans[side]):
                groups[bisect.bisect_left(cuts, e)][side].append(i)
        docs.append((ids, groups, Counter((x, y) for g in groups for x in g[0] for y in g[1])))
    count = Counter(p for _, _, links in docs for p in links)
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for ids, groups, links in docs:
        text = ";".join("|".join(",".join(map(str, side)) for side in g) for g in groups)
        out.append((len(ids[0]), len(ids[1]), len(groups), sum(links.values()),
                    sum(n for p, n in links.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in links.items()),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


def scored(spark, df, how=alignment.Alignment()):
    found = alignment.align(df, JSON, MODEL, how)
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    return alignment.link_scores(found.withColumn("digest", digest), Stages(spark, "t"))


def columns(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.digest)


@pytest.mark.parametrize("how", [alignment.Alignment(), alignment.Alignment(block_bytes=1, group_links=2, cached=5)])
def test_equals_pair_by_pair(spark, edge_docs, edge_texts, libraries, how):
    texts = [*edge_texts, *ODD]
    rows = sorted(scored(spark, documents(spark, texts), how).collect(), key=lambda r: r.id)
    for r, text, want in zip(rows, texts, brute(texts, libraries), strict=True):
        assert columns(r) == want, (text or "")[:60]
    assert rows[len(edge_texts)].n_a == 0  # the blank itself in a text cannot be told from a space
    assert len(scored(spark, edge_docs).collect()) == len(edge_texts)  # columns of internal names


def test_null_ids_repeats_and_no_rows(spark, empty_docs, libraries):
    assert scored(spark, empty_docs).collect() == []
    texts = ["some words", "some words", "other", None]
    df = spark.createDataFrame(list(zip([None, 7, 7, None], texts)), "doc_id long, text string")
    assert sorted(columns(r) for r in scored(spark, df).collect()) == sorted(brute(texts, libraries))


def test_query(spark, small, libraries):
    from corpusmill.llm.queries import QUERIES
    docs = sorted(spark.read.parquet(f"{small}/documents.parquet").collect(), key=lambda r: r.doc_id)
    rows = sorted(QUERIES["op13_token_alignment"](spark, small).collect(), key=lambda r: r.doc_id)
    got = [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows]
    assert [r.doc_id for r in rows] == [d.doc_id for d in docs] and got == brute([d.text for d in docs], libraries)


def test_groups_of_random_ends():
    rng = random.Random(2)
    for _ in range(400):
        n, keep = rng.randint(1, 60), rng.choice([0.3, 0.8, 0.97, 1.0])
        a, b = (sorted({n, *(x for x in range(1, n) if rng.random() < keep)}) for _ in range(2))
        cuts = sorted({*a} & {*b})
        end_a, end_b = alignment.groups_of(a, b)
        assert [a[k - 1] for k in end_a] == cuts == [b[k - 1] for k in end_b]
    assert [len(x) for x in alignment.groups_of([], [])] == [0, 0]


def test_fragments_equal_whole_texts(words, libraries):
    a, b, *_ = libraries
    aligner = alignment.Aligner(open(JSON, encoding="utf-8").read(), open(MODEL, "rb").read(), alignment.Alignment(cached=50))
    rng = random.Random(4)
    pieces = [" ", "  ", "a", "the ", "é", "\n", ".", "漢", "🙂", "'s", " 'll", "\xa0", "\u3000", "\x1c", "12", "!?", *words[:20]]
    assert aligner.apart
    for _ in range(80):
        texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(20)] + [" ".join(words[:50])]
        for text, x, y in zip(texts, *aligner.tokens(texts), strict=True):
            assert x.tolist() == a.encode(" " + text, add_special_tokens=False).ids, text
            assert y.tolist() == b.encode(text), text


class Counted:
    """The tokenizer, counting the texts that it is given."""

    def __init__(self, tokenizer):
        self.tokenizer, self.n = tokenizer, 0

    def encode_batch_fast(self, texts, **how):
        self.n += len(texts)
        return self.tokenizer.encode_batch_fast(texts, **how)


def counted(cached=400_000):
    aligner = alignment.Aligner(open(JSON, encoding="utf-8").read(), open(MODEL, "rb").read(), alignment.Alignment(cached=cached))
    aligner.a = Counted(aligner.a)
    return aligner


def same_as_libraries(aligner, texts, libraries):
    a, b, spell_a, spell_b = libraries
    for text, x, y in zip(texts, *aligner.tokens(texts), strict=True):
        ids = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        if not text or not all(b"".join(map(f, own)) == b" " + text.encode() for own, f in zip(ids, (spell_a, spell_b))):
            ids = [], []
        assert (x.tolist(), y.tolist()) == ids, text[:60]


def test_new_fragments_are_encoded_together(libraries):
    rng = random.Random(6)
    fragments = ["".join(rng.choice("abcdeé漢.,'1") for _ in range(rng.randint(1, 9))) for _ in range(3000)]
    aligner = counted()
    same_as_libraries(aligner, [" ".join(fragments[i:i + 100]) for i in range(0, 3000, 100)], libraries)
    assert aligner.a.n <= 20
    # a few that are no safe cut leave the others together
    aligner = counted()
    odd = ["a▁b", "▁", "x\n", "\ty", "z" * 200 + "▁", "w" * 200]
    same_as_libraries(aligner, [*(" ".join(fragments[i:i + 100]) for i in range(0, 3000, 100)), *odd, " ".join(odd), ""], libraries)
    assert aligner.a.n <= 100
    assert not any(len(f) > alignment.LONG for f in aligner.known)


def test_a_full_cache_keeps_what_is_used_often(libraries):
    aligner, often = counted(cached=100), [f"often{i}" for i in range(40)]
    for k in range(12):
        once = [f"once{k}x{i}" for i in range(30)]
        same_as_libraries(aligner, [" ".join([*often, *once]), " ".join(reversed(often))], libraries)
        assert len(aligner.known) <= 140 and len(aligner.kept[0][0]) <= 141
        assert k == 0 or set(often) <= set(aligner.known)
    assert aligner.a.n == 12  # fragments of a batch are one text; the often used ones come but once
    for k in range(12):  # too many are used often: all go
        same_as_libraries(aligner, 2 * [" ".join(f"many{k}x{i}" for i in range(90))], libraries)
        assert len(aligner.known) <= 240
