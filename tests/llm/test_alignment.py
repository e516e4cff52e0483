import hashlib
import random
import time
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from screenmeld.llm import alignment as A
from screenmeld.llm.queries import QUERIES, vocabulary

FILES = {**vocabulary(), "pieces": public_tokenizers.path("piece_bpe_32k.model")}
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain():
    """Both encoders as the libraries give them, with the bytes of ids found independently of the operator."""
    first = Tokenizer.from_file(FILES["path"])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=FILES["pieces"])
    letters, extra = {}, 256
    for b in range(256):
        if chr(b).isprintable() and not chr(b).isspace() and b != 173:
            letters[chr(b)] = b
        else:
            letters[chr(extra)] = b
            extra += 1

    def encode(text):
        a = first.encode(" " + text, add_special_tokens=False).ids
        b = second.encode(text)
        spell = lambda k: bytes.fromhex(second.id_to_piece(k)[3:5]) if second.is_byte(k) else second.id_to_piece(k).replace("▁", " ").encode()
        return [(k, bytes(letters[c] for c in first.id_to_token(k))) for k in a], [(k, spell(k)) for k in b]
    return encode


def brute(texts, encode):
    """Spans compared one by one."""
    per, counts = [], Counter()
    for text in texts:
        a, b = encode(text) if text else ([], [])
        raw = (" " + (text or "")).encode()
        if not text or b"".join(x for _, x in a) != raw or b"".join(x for _, x in b) != raw:
            per.append(None)
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for k, x in side:
                out.append((k, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links, low = [], 0
        for k, s, e in spans[0]:
            while spans[1][low][2] <= s:
                low += 1
            j = low
            while j < len(spans[1]) and spans[1][j][1] < e:
                links.append((k, spans[1][j][0]))
                j += 1
        counts.update(links)
        ends = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups, i, j = [], 0, 0
        for end in ends:
            parts = []
            for side, at in ((spans[0], i), (spans[1], j)):
                n = at
                while n < len(side) and side[n][2] <= end:
                    n += 1
                parts.append((",".join(str(k) for k, *_ in side[at:n]), n))
            groups.append(f"{parts[0][0]}|{parts[1][0]}")
            i, j = parts[0][1], parts[1][1]
        per.append((len(a), len(b), len(ends), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
    most = defaultdict(int)
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    return [(0, 0, 0, 0, 0, 0, "") if x is None else
            (*x[:3], len(x[3]), sum(counts[p] == most[p[1]] for p in x[3]), sum(counts[p] for p in x[3]), x[4]) for x in per]


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_query(spark, plain, sf):
    docs = spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet").collect()
    rows = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in QUERIES["op13_token_alignment"](spark, f"/root/testdata/sf{sf}").collect()}
    assert len(rows) == len(docs)
    assert rows == dict(zip([d.doc_id for d in docs], brute([d.text for d in docs], plain)))


ODD = ["", None, " ", "\n\n\t", "a", "<|endoftext|> inside <|endoftext|>", "<s> </s> <unk> <0x41>", "a▁b", "naïve café ﬁ ２", "日本語のテキスト 漢字",
       "👩‍👩‍👧 🏳️‍🌈", "\x00\x01 control", "é combining", "tab\tand  two  spaces   ", " leading", "x" * 3000, "1." * 500, "word " * 400,
       "؁ العربية", "  line", "don't I'll WE'VE", "same", "same", "𝔘𝔫𝔦"]


@pytest.mark.parametrize("common", [1, 50, 1_000_000])
def test_odd_texts(make, plain, common):
    rows = A.align(make([(k // 2, t) for k, t in enumerate(ODD)]), common, **FILES).collect()
    want = sorted(zip([k // 2 for k in range(len(ODD))], brute(ODD, plain)))
    assert sorted((r.doc_id, tuple(r[c] for c in COLUMNS)) for r in rows) == want
    assert sum(w[1][0] > 0 for w in want) > len(ODD) // 2


def test_random_texts(make, plain, monkeypatch):
    monkeypatch.setattr(A, "TOGETHER", 500)
    rng = random.Random(1)
    letters = ["a", "b", " ", "\n", "é", "<|endoftext|>", "12", ".", "the ", "ing", "ß", "漢", "'s", " ", "ɏ", "ÿ"]
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    rows = sorted(A.align(make(list(enumerate(texts))), **FILES).collect())
    assert [tuple(r[c] for c in COLUMNS) for r in rows] == brute(texts, plain)


def test_cuts_equal_an_intersection():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 400))
        a, b = (np.unique(np.append(rng.choice(n, rng.integers(0, n), replace=False) + 1, n)) for _ in range(2))
        docs = np.intersect1d(a, b)[-1:]
        i, j = A.shared_cuts(a, b, docs)
        assert (a[i] == np.intersect1d(a, b)).all() and (b[j] == a[i]).all()


def test_cutless_stretches_stay_cheap():
    n = 300_000
    odd, even = np.arange(1, 2 * n, 2), np.arange(2, 2 * n + 1, 2)
    a, b = np.append(odd, 2 * n), even
    start = time.process_time()
    assert A.shared_cuts(a, b, np.array([2 * n])).shape == (2, 1)
    assert time.process_time() - start < 30


def test_odd_rows_and_long_texts(odd, empty, make):
    rows = A.align(odd, **FILES).collect()
    assert len(rows) == odd.count() and all(len(r.groups_sha256) == (64 if r.n_a else 0) for r in rows)
    assert A.align(empty, **FILES).count() == 0
    long = A.align(make([(1, "lorem ipsum dolor " * 20_000), (2, "z" * 200_000), (3, "1." * 100_000)]), **FILES).collect()
    assert all(r.n_links == r.n_a + r.n_b - r.n_groups > 0 for r in long)
