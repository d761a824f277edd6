"""The pipeline from documents to sequences against brute force."""

import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers

import corpus_pipeline
from tests.llm.test_llm import norm, spec_fingerprint, spec_matches

WORDS = {"en": "the house and water of this town with that old tree under green hill", "fr": "la maison et les eaux de cette ville avec un vieil arbre sous colline", "de": "das haus und wasser von dieser stadt mit einem alten baum unter berg"}


def documents():
    rng = np.random.default_rng(8)
    texts = {i: (" ".join(rng.choice(WORDS[lang].split(), 80)), lang) for i, lang in enumerate(["en", "fr", "de"] * 10)}
    rows = [(i, t, lang) for i, (t, lang) in texts.items()]
    rows += [(100 + i, texts[i][0].upper().replace("É", "é"), "en") for i in range(5)]  # exact copies but for case: the larger id stays
    rows += [(200 + i, texts[10 + i][0] + " tree", None) for i in range(5)]  # near copies: the smaller id stays
    rows += [(300, "the water and password = hunter22x of that town with AKIA" + "B" * 16, "en"), (301, None, "en"), (302, "", "fr"), (303, "12 34 !!", None), (None, "under the green hill with water and tree of that old town", None)]
    rows += [(304, " ".join(rng.choice(WORDS["de"].split(), 9000)), "de"), (305, "".join(rng.choice([*"bcdfghjkmnpqrstvwxz"], 500)), None)]
    rows += [rows[7], rows[7], (8, "la maison sous les eaux de un arbre", "fr")]  # a repeated row, and an id with two texts
    return [(i, t, lang, "web", len(t or ""), 1, "k") for i, t, lang in rows]


def brute_force(rows):
    kept = [(i, t) for i, t, *_ in rows if re.search(r"[^\W\d_]", t or "") and i != 305]  # 305 has letters by chance
    groups = defaultdict(list)
    for i, t in kept:
        groups[norm(t)].append((i, t))
    low = lambda i: (i is not None, i)
    single = [max(own, key=lambda r: low(r[0])) for own in groups.values()]
    prints = [spec_fingerprint(t) for _, t in single]
    root = [*range(len(single))]

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(single)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= 3:
                root[find(a)] = find(b)
    components = defaultdict(list)
    for k, row in enumerate(single):
        components[find(k)].append(row)
    left = [min(own, key=lambda r: (r[0] is None, r[0] or 0)) for own in components.values()]
    masked = []
    for i, t in left:
        out, at = "", 0
        for s, _, e, _ in spec_matches(t):
            if s >= at:
                out += t[at:s] + "[SECRET]"
            at = max(at, e)
        masked.append((i, out + t[at:]))
    return kept, single, left, masked


def test_pipeline(spark, tmp_path):
    from tokenizers import Tokenizer

    rows = documents()
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `count` int, __k string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    kept, single, left, masked = brute_force(rows)
    assert len(kept) > len(single) > len(left)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    library, want = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), Counter()
    for i, t in masked:
        ids = [*library.encode(t, add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), 2048)):
            cut = ids[at : at + 2048]
            want[i, p, at, len(cut), zlib.crc32(struct.pack(f"<{len(cut)}I", *cut))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= 2048


def test_stages_keep_the_columns(spark):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, `count` int, __k string")
    kept, *_ = brute_force(rows)
    first = corpus_pipeline.STAGES[0][1](spark, df, "")
    assert first.columns == df.columns and Counter((r.doc_id, r.text) for r in first.collect()) == Counter(kept)
    by_id = {r.doc_id: r.lang for r in first.where("doc_id >= 200 and doc_id < 300").collect()}
    assert by_id == {200 + i: ["en", "fr", "de"][(10 + i) % 3] for i in range(5)}  # a null lang is filled in
    for _, stage in corpus_pipeline.STAGES[1:-1]:
        assert stage(spark, df, "").columns == df.columns and stage(spark, df.limit(0), "").count() == 0
