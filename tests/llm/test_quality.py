import random
import re
import string
from collections import Counter

from screenmeld.llm import quality as Q
from screenmeld.llm.queries import QUERIES


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    n = len(words)
    return (n, sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), dup, len(covered),
            n < 50 or 100 * len(covered) > 50 * n)


def check(rows, texts):
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == plain(texts[r.doc_id])
        assert not (r.base_failed and r.kept)


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op6_quality_bands"](spark, sf).collect()
    assert len(rows) == len(texts)
    check(rows, texts)


def test_bands_reject_repetition_and_noise(make):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("etaoinshrdlucmfwypvbgk") for _ in range(rng.randint(2, 9))) for _ in range(700)]
    prose = " ".join(rng.choice(vocabulary) for _ in range(900))
    noise = " ".join("".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(60)) for _ in range(200))
    half = " ".join(f"{k} same words again {k % 7}" for k in range(2000))
    rows = {r.doc_id: r for r in Q.compression_bands(make([(1, prose), (2, noise), (3, half)])).collect()}
    assert rows[1].kept and not rows[2].kept and not rows[3].kept
    assert rows[2].ratio < 1.5 and rows[2].n_chunks_out == rows[2].n_chunks


def test_encoded_tail_behind_the_last_full_chunk_is_judged(make):
    rng = random.Random(5)
    vocabulary = ["".join(rng.choice("etaoinshrdlucmfwypvbgk") for _ in range(rng.randint(2, 9))) for _ in range(700)]
    prose = " ".join(rng.choice(vocabulary) for _ in range(2000))
    noise = " ".join("".join(rng.choice(string.ascii_letters + string.digits + "+/") for _ in range(60)) for _ in range(80))
    tails = (1300, 2000, 3000, 3900, 4095)
    rows = [(k, prose[:4096] + noise[:k]) for k in tails] + [(-k, prose[:4096 + k]) for k in (0, 1, 300, *tails)]
    got = {r.doc_id: r for r in Q.compression_bands(make(rows)).collect()}
    for k in tails:
        assert (got[k].n_chunks, got[k].n_chunks_out, got[k].kept) == (2, 1, False)
    for k in (1, 300, *tails):
        assert (got[-k].n_chunks, got[-k].n_chunks_out, got[-k].kept) == (2, 0, True)
    assert (got[0].n_chunks, got[0].kept) == (1, True)


def test_labelled_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").filter("quality = 1").collect()}
    rows = [r for r in QUERIES["op6_quality_bands"](spark, sf).collect() if r.doc_id in good and not r.base_failed]
    assert rows and all(r.kept for r in rows)


def test_odd_rows(odd, empty):
    rows = Q.compression_bands(odd).collect()
    assert len(rows) == odd.count()
    check([r for r in rows if r.doc_id in (1, 2, 3, 4, 8, 9, 10)], {r.doc_id: r.text for r in odd.collect()})
    assert [r.ratio for r in rows if r.doc_id == 1] == [0.0]
    assert Q.compression_bands(empty).count() == 0
