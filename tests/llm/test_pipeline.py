import corpus_pipeline as C
from screenmeld.llm import language, line_dedup, mixing, neardup, packing
from screenmeld.session import stage

SF = "/root/testdata/sf0.001"


def test_stages_in_order_keep_the_columns(spark):
    docs = C.documents(spark, SF)
    columns, counts = docs.columns, [docs.count()]
    assert [name for name, _ in C.STAGES] == ["language", "line_dedup", "near_dedup", "mixing", "packing"]
    clean = docs.filter("text RLIKE '[A-Za-z]{3}'").count()
    for name, function in C.STAGES[:-1]:
        docs = stage(function(spark, docs, SF), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[1] >= clean and counts[2] == counts[1] and counts[3] < counts[2]
    words = docs.agg({"text": "count"}).first()[0]
    assert words == counts[4]
    pieces = C.STAGES[-1][1](spark, docs, SF)
    assert pieces.filter("piece = 0").count() == counts[4]


def test_run_equals_the_stages_by_hand(spark):
    docs = C.documents(spark, SF)
    docs = stage(language.identified(docs, least=C.LEAST_LANGUAGE_SCORE), "t")
    docs = stage(line_dedup.without_repeated_lines(docs), "t")
    docs = stage(neardup.one_of_each(docs), "t")
    docs = stage(mixing.mixed(docs), "t")
    keys = ["doc_id", "piece", "start", "length", "ids_crc32"]
    by_hand = packing.pack(docs, **C.vocabulary()).select(*keys)
    assert sorted(map(tuple, C.run(spark, SF).select(*keys).collect())) == sorted(map(tuple, by_hand.collect()))


def test_empty_documents(spark):
    docs = C.documents(spark, SF).limit(0)
    for name, function in C.STAGES:
        docs = stage(function(spark, docs, SF), name)
        assert docs.count() == 0
