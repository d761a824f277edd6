import public_tokenizers

from tabularium.llm import neighbours, packing

COLUMNS = "vec_id long, embedding array<float>, rank int, score string, query_id string"


def test_neighbours_without_rows_and_with_clashing_columns(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert neighbours.nearest(empty).collect() == []
    rows = [(i, [float(i + 1), 1.0], 9, "x", None) for i in range(5)] + [(20, [1.0, 2.0], 9, "x", None), (21, None, 9, "x", None)]
    got = sorted(map(tuple, neighbours.nearest(spark.createDataFrame(rows, COLUMNS)).select("query_id", "rank", "vec_id", "score").collect()))
    vectors = {i: v for i, v, *_ in rows if v}
    want = []
    for q in (0, 20):
        near = sorted((-sum(a * b for a, b in zip(vectors[q], v)), i) for i, v in vectors.items() if i != q)
        want += [(q, r, i, -s) for r, (s, i) in enumerate(near, 1)]
    assert got == sorted(want)


def test_packing_with_clashing_columns(spark):
    docs = spark.createDataFrame([(1, "a b c", 7, "x"), (1, "a b c", 7, "x"), (None, None, None, None)], "doc_id long, text string, sequence_id int, offset string")
    got = packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json")).collect()
    assert sorted((r.doc_id or 0, r.piece, r.start, r.length) for r in got) == [(0, 0, 0, 1), (1, 0, 0, 4), (1, 0, 0, 4)]
    assert len({r.sequence_id for r in got}) == 1 and sorted(r.offset for r in got) in ([0, 1, 5], [0, 4, 5], [0, 4, 8])
