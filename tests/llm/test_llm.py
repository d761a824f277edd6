"""Each operator against a brute-force version or an exact round trip, and on awkward rows."""

import hashlib
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tabularium.llm import bpe, exact_dedup, language, line_dedup, near_dedup, neighbours, packing, quality, secrets, toxicity, words
from tabularium.llm.components import components

DOCS = "doc_id long, text string, kept string, rank int, __x string"
ROWS = [
    (1, "The cat sat on the mat near the old door.", None, 1, "a"),
    (2, "the CAT sat on the mat near the old door.", "k", 2, "b"),
    (3, None, None, None, None),
    (4, "", "k", 3, "c"),
    (4, "", "k", 3, "c"),
    (5, "É tudo água " * 400, None, 4, "d"),
    (None, "no id here", None, 5, "e"),
    (6, "x", None, 6, "f"),
    (7, "!!! ### 12345", None, 7, "g"),
    (8, "w" * 6000, None, 8, "h"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


def norm(t):
    return re.sub("[A-Z]", lambda m: m[0].lower(), t or "")


def test_exact_dedup(spark, docs):
    groups = defaultdict(list)
    for i, t, *_ in ROWS:
        groups[norm(t)].append(i)
    want = Counter()
    for i, t, *_ in ROWS:
        own = groups[norm(t)]
        keep = max((x for x in own if x is not None), default=None)
        want[i, keep, len(own), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()] += 1
    assert Counter(map(tuple, exact_dedup.duplicate_groups(docs).collect())) == want
    kept = exact_dedup.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 4, 5, 6, 7, 8]


def test_exact_dedup_of_a_hot_text(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "same").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"))
    got = exact_dedup.duplicate_groups(df)
    assert got.where("kept").count() == 2001 and got.where("group_size = 2000 and keep_id = 3998").count() == 2000


def spec_fingerprint(text):
    from xxhash import xxh64_intdigest

    tokens = re.findall(r"[^\x20\x09-\x0d]+", norm(text))
    if not tokens:
        return 0
    hashes = [xxh64_intdigest(" ".join(tokens[i : i + 3]).encode(), 42) for i in range(max(1, len(tokens) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints(docs, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    for _, t, *_ in ROWS:
        assert near_dedup.fingerprint(t or "") & (1 << 64) - 1 == spec_fingerprint(t or "")


def test_near_dedup_links_all_within_three_bits(spark, monkeypatch):
    rng = np.random.default_rng(4)
    prints = []
    for _ in range(40):
        base = int(rng.integers(0, 1 << 63))
        prints += [base] + [base ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(1, 6)), replace=False)) for _ in range(6)]
    prints += [0, 1, 0b111, 0b1111111]
    signed = [p - (1 << 64) if p >> 63 else p for p in dict.fromkeys(prints)]
    found = {tuple(sorted(r)) for r in near_dedup.links(spark.createDataFrame([(p,) for p in signed], "fp long")).distinct().collect()}
    want = {tuple(sorted((a, b))) for i, a in enumerate(signed) for b in signed[:i] if bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    assert found == want


def test_near_duplicates(spark, docs):
    got = near_dedup.near_duplicates(docs).collect()
    by_print = defaultdict(list)
    for i, t, *_ in ROWS:
        by_print[spec_fingerprint(t or "")].append(i)
    assert len(got) == len(ROWS)
    assert Counter((r.doc_id, int(r.fingerprint, 16)) for r in got) == Counter((i, spec_fingerprint(t or "")) for i, t, *_ in ROWS)
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == {1} and {r.component_id for r in got if r.doc_id in (3, 4)} == {3}
    left = near_dedup.drop_near_duplicates(docs)
    assert left.columns == docs.columns and {r.doc_id for r in left.collect()} == {1, 3, 5, 6, 7, 8, None}


def test_drop_near_duplicates_by_row(spark):
    one, two, three, four = (" ".join(f"{w}{i}" for i in range(60)) for w in ("river", "stone", "cloud", "paper"))
    rows = [(0, one), (1, one.upper()), (1, two), (2, three), (2, three.upper()), (2, three), (None, four), (None, four.upper()), (None, one), (5, "alone here")]
    left = near_dedup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter((r.doc_id, r.text.lower()) for r in left) == Counter([(0, one), (1, two), (2, three), (None, four), (5, "alone here")])


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 101 + i) for i in range(50)] + [(7, 7)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(31)} | {100 + i: 100 for i in range(51)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


SPEC_RULES = [  # kind, pattern, group that is measured, characters at least
    ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE, 2, 6),
    ("access", r"AKIA[A-Z0-9]+", 0, 0, 20),
    ("hex", r"[0-9a-f]+", 0, 0, 24),
    ("github", r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 0, 0),
    ("pem", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----", 0, 0, 0),
]


def spec_matches(text):
    return sorted((m.start(), rank, m.end(), kind) for rank, (kind, p, flags, group, least) in enumerate(SPEC_RULES) for m in re.finditer(p, text, flags) if len(m.group(group)) >= least)


def spec_spans(text):
    return ",".join(f"{k}:{s}:{e}" for s, _, e, k in spec_matches(text))


SECRETS = ["secret=token = abcdefgh", "é token: 'abc.def' AKIA" + "A" * 16, "apikey=12345 API_KEY = zzzzzz password=pass", "f" * 24 + " " + "f" * 23, "passwd==aaaaaa token", "tokentoken=aaaaaaa", None, "", "ghp_" + "a" * 36, "-----BEGIN RSA PRIVATE KEY-----", "a secret=" + "x" * 50_000]


def test_secrets(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(SECRETS)] + [(0, "secret: other1")], "doc_id long, text string")
    got = Counter((r.doc_id, r.spans) for r in secrets.digests(df).collect())
    assert got == Counter((i, spec_spans(t or "")) for i, t in [*enumerate(SECRETS), (0, "secret: other1")])
    redacted = {r.doc_id: r.text for r in secrets.redact(df.where("doc_id > 0")).collect()}
    assert redacted[1] == "é [SECRET]' [SECRET]" and redacted[6] is None and redacted[3].endswith(" " + "f" * 23)


def test_trigram_queries_hold_for_every_match():
    for rule in secrets.RULES:
        query = secrets.trigram_query(rule.pattern)
        for text in SECRETS:
            if text and re.search(rule.pattern, text):
                assert any(all(t in text.lower() for t in c) for c in query)
    assert secrets.trigram_query("[0-9a-f]+") == secrets.ANY and secrets.trigram_query("ab") == secrets.ANY
    assert secrets.trigram_query("abc|bcd") == frozenset({frozenset({"abc"}), frozenset({"bcd"})})


def test_line_dedup(spark):
    def body(i):
        return f"Copyright {2000 + i} the example authors of this\n{'abcdefghij'[i]}{'klmnopqrst'[i]} is the unique text that stands right here alone\nshort"

    rows = [(i, body(i)) for i in range(6)] + [(6, None), (7, ""), (0, body(0))]
    got = {r.doc_id: (r.text, r.n_lines, r.n_dropped) for r in line_dedup.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i in range(6):
        assert got[i][0].endswith("stands right here alone") and "\n" not in got[i][0] and got[i][1:] == (3, 2)
    assert got[6] == (None, 1, 0) and got[7] == ("", 1, 0)


def test_line_dedup_finds_each_template_of_a_leaf(spark):
    name = lambda i: "abcdefghij"[i // 10] + "klmnopqrst"[i % 10]
    edited = [(i, f"This page was last edited by the user {name(i)} here") for i in range(40)]
    copied = [(100 + i, "This page shows how to cook some very good rice") for i in range(120)]  # one text
    moved = [(300 + i, f"This page has been moved from the {name(i)} site today") for i in range(20)]
    got = {r.doc_id: r.n_dropped for r in line_dedup.drop_lines(spark.createDataFrame(edited + copied + moved, "doc_id long, text string")).collect()}
    assert {i for i, n in got.items() if n} == {i for i, _ in edited + moved} and len(got) == 180


LINES = [
    *((i, f"The server host {w} answered with the code of all good") for i, w in enumerate("abcdef")),
    *((10 + i, f"The server is {w} going down for some very short time") for i, w in enumerate("ghijk")),  # a second template of a leaf
    *((100 + i, "Copyright notice that fifty copies of one text have here") for i in range(50)),
    *((200 + i, f"Copyright notice of the year {i} for the author {w}\nOf {w * 3} alone") for i, w in enumerate("lmnop")),
    *((300 + i, f"{w * 4}\nRead more") for i, w in enumerate("abc")),  # a short line
    *((310 + i, f"Read\t {w * 5}") for i, w in enumerate("abc")),  # two tokens agree with no other line
    *((320 + i, f"{i} 2 {i}\n1 2 3 4\n \n{w * 6}") for i, w in enumerate("abc")),  # fields only: exact repeats go
    (330, "once xy\nonce xy\nonce xy"),  # often, but in one text
    (331, "z" * 300_000 + "1"),
    (332, None),
    (None, "\u3000 no id"),
]


def spec_lines(rows):
    """(row, line) of the lines that go, by the docstring."""
    found = {}
    for k, (_, text) in enumerate(rows):
        for pos, line in enumerate((text or "").split("\n")):
            raw = re.findall(r"[^\x09-\x0d\x20]+", line)
            masked = ["<*>" if re.search("[0-9]", t) else t for t in raw]
            if raw:
                found[k, pos] = tuple(masked if {*masked} != {"<*>"} else raw)
    texts = defaultdict(set)
    leaf = lambda toks: (len(toks), toks[:2])
    for (k, _), toks in found.items():
        for place, t in enumerate(toks):
            texts[leaf(toks), place, t].add(rows[k][1])
    template, having = {}, defaultdict(set)
    for (k, pos), toks in found.items():
        constant = tuple(t if t != "<*>" and len(texts[leaf(toks), place, t]) >= 3 else None for place, t in enumerate(toks))
        template[k, pos] = (leaf(toks), constant) if len(toks) - constant.count(None) >= 0.7 * len(toks) else toks
        having[template[k, pos]].add(rows[k][1])
    return {at for at, name in template.items() if len(having[name]) >= 3}


def test_line_dedup_by_brute_force(spark):
    df = spark.createDataFrame([(i, t, 7, "x") for i, t in LINES], "doc_id long, text string, N_Lines int, __y string").repartition(3)
    out = line_dedup.drop_lines(df)
    assert sorted(out.columns) == ["__y", "doc_id", "n_dropped", "n_lines", "text"]
    gone = spec_lines(LINES)
    want = Counter()
    for k, (i, text) in enumerate(LINES):
        lines = (text or "").split("\n")
        lost = [pos for pos in range(len(lines)) if (k, pos) in gone]
        want[i, text if not lost else "\n".join(x for pos, x in enumerate(lines) if pos not in lost), len(lines), len(lost)] += 1
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in out.collect()) == want
    dropped = {LINES[k][0] for k, _ in gone}
    assert dropped == {*range(6), *range(10, 15), *range(200, 205), *range(300, 303), *range(320, 323)}


TOKENS = ["", "<|endoftext|>a<|endoftext|>", "x" * 3000, " \n\n a  b\t\tc ", "it's we'll I'LL", "\x1cfoo\x1d!! \x85   x", "Ünïcodé ﬁ ΑΣ ΌΣΟΣ 中文字 😀 é", "a b", "İstanbul ſecret", "abc" * 500 + " 0123456789" * 50, "́a b́"]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_bpe_equals_the_library(name):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    encoder, library = bpe.Encoder(path, bpe.compiled_lexicon(path, ("the", "it's", "Ünïcodé", "a1,b"))), Tokenizer.from_file(path)
    decoder = bpe.Decoder(encoder.model)
    plain = bpe.Lexicon(bpe.compiled_lexicon(path))
    assert encoder.lexicon.words > plain.words and encoder.lexicon.get((" Ünïcodé" if name.startswith("byte") else "ünïcodé").encode()) and not plain.get((" Ünïcodé" if name.startswith("byte") else "ünïcodé").encode())
    rng = np.random.default_rng(0)
    alphabet = [*"ab 'sxX\n\t<|>é中12.,", "̀", "\x1f", "\x85"]
    texts = TOKENS + ["".join(rng.choice(alphabet, int(rng.integers(1, 60)))) for _ in range(500)]
    for t in texts:
        ids = [*struct.unpack(f"<{len(raw := encoder.encode(t)) // 4}I", raw)]
        assert ids == library.encode(t, add_special_tokens=False).ids, t
        if name.startswith("byte"):
            assert decoder.decode(raw) == library.decode(ids, skip_special_tokens=False)


def test_transducer_is_minimal_and_exact():
    entries = {b"tests": [1], b"rests": [2, 3], b"test": [4], b"rest": [5], b"": [6]}
    lexicon = bpe.Lexicon(bpe.compile_lexicon(entries))
    assert lexicon.states == 6  # root, and the shared e-s-t-s chain
    for w, ids in entries.items():
        assert lexicon.get(w) == struct.pack(f"<{len(ids)}I", *ids)
    assert lexicon.get(b"tes") is None and lexicon.get(b"testsx") is None


def test_frequent_runs(spark):
    df = spark.createDataFrame([(i, f"tick tock tick w{i} {'long' * 20}") for i in range(50)] + [(None, ""), (7, "w7")], "doc_id long, text string")
    assert bpe.frequent_runs(df) == ["tick", "tock", "w7"] and bpe.frequent_runs(df, most=1) == ["tick"] and bpe.frequent_runs(df.limit(0)) == []


def test_bpe_query_columns(docs):
    rows = bpe.encode_digests(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert len(rows) == len(ROWS)
    assert Counter(r.decoded_sha256 for r in rows) == Counter(hashlib.sha256((t or "").encode()).hexdigest() for _, t, *_ in ROWS)


def test_packing(spark, docs):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    got = packing.pack_documents(docs, path).collect()
    want = Counter()
    for i, t, *_ in ROWS:
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 0]
        for p, at in enumerate(range(0, len(ids), packing.CAPACITY)):
            cut = ids[at : at + packing.CAPACITY]
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
        assert end <= packing.CAPACITY
    assert packing.pack_documents(docs.limit(0), path).count() == 0


def test_plans_are_no_worse_than_best_fit():
    rng = np.random.default_rng(1)
    for n in (50, 5000):
        h = np.bincount(np.clip(np.exp(rng.normal(6, 1, n)).astype(int), 1, 512), minlength=513)
        made = packing.plan(h, 512)
        assert made.sequences <= sum(k for k, _ in packing.best_fit(h, 512)) and made.sequences >= -(-(h * np.arange(513)).sum() // 512)


def test_forward_sums_all_segmentations():
    pieces = ["a", "b", "ab", "aba", "ba"]
    lattice, p = language.Lattice(pieces), np.array([0.3, 0.2, 0.25, 0.15, 0.1, 0.0, language.UNKNOWN])[:, None]

    def total(s):
        return 1.0 if not s else sum(p[pieces.index(x), 0] * total(s[len(x) :]) for x in pieces if s.startswith(x))

    for word in ("abab", "b", "aabba"):
        assert language.forward(lattice.of([word]), p)[0, -1, 0] == pytest.approx(total(word))
        assert language.log_forward(lattice.of([word]), p)[0] == pytest.approx(np.log(total(word)))


def test_language(spark, docs):
    text = {"en": "the house and the water of this town with that old tree", "fr": "la maison et les eaux de cette ville avec un vieil arbre", "de": "das haus und die wasser von dieser stadt mit einem alten baum"}
    rows = [(i, " ".join(np.random.default_rng(i).permutation(text[lang].split())), lang) for i, lang in enumerate(["en", "fr", "de"] * 12)]
    rows += [(100, None, "en"), (101, "123 !!", "fr"), (102, "", None), (None, text["fr"], None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    path = public_tokenizers.path("piece_bpe_32k.model")
    got = {r.doc_id: r for r in language.identify(df, path).collect()}
    assert all(got[i].lang_pred == lang and 0 <= got[i].score <= 1 for i, _, lang in rows[:36])
    assert [got[i].lang_pred for i in (100, 101, 102)] == ["und"] * 3 and got[None].lang_pred == "fr"
    assert {i: r.held_out for i, r in got.items() if i is not None} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, *_ in rows if i is not None}
    assert language.keep_identified(df, path).count() == 37
    assert {r.lang_pred for r in language.identify(df.withColumn("lang", F.lit(None).cast("string")), path).collect()} == {"und"}


def labelled(spark, n, bad):
    rng = np.random.default_rng(2)
    words_ = ["river", "stone", "green", "cloud", "table", "music", "paper", "light"]
    rows = []
    for i in range(n):
        own = [*rng.choice(words_, 40)]
        if i % 3 == 0:
            own = bad(own, rng)
        rows.append((i, " ".join(own), int(i % 3 == 0)))
    return spark.createDataFrame([(i, t) for i, t, _ in rows] + [(None, "x"), (n, None), (n + 1, "")], "doc_id long, text string"), spark.createDataFrame([(i, v) for i, _, v in rows] + [(5, None)], "doc_id long, label int")


def test_toxicity(spark):
    docs, labels = labelled(spark, 240, lambda own, rng: own[:20] + [str(rng.choice(["idiot", "moron"])), "scum"] + own[20:])
    got = toxicity.classify(docs, labels.withColumnRenamed("label", "toxic")).collect()
    held = [r for r in got if r.doc_id is not None and r.doc_id < 240 and r.held_out]
    assert len(got) == 243 and all(r.predicted == int(r.score >= 0.7) for r in got)
    assert np.mean([r.predicted == int(r.doc_id % 3 == 0) for r in held]) > 0.95
    assert {r.score for r in toxicity.classify(docs, labels.select("doc_id", F.lit(0).alias("toxic"))).collect()} == {0.0}


def test_quality(spark):
    docs, labels = labelled(spark, 240, lambda own, rng: [w.upper() + "!!" for w in own])
    got = quality.classify(docs, labels.select("doc_id", (1 - F.col("label")).alias("quality"))).collect()
    held = [r for r in got if r.doc_id is not None and r.doc_id < 240 and r.held_out]
    assert len(got) == 243 and np.mean([r.predicted == int(r.doc_id % 3 != 0) for r in held]) > 0.95
    assert {r.score for r in quality.classify(docs, labels.where("false").withColumnRenamed("label", "quality")).collect()} == {0.5}


def test_quality_reads_texts_without_spaces_whole():
    start = "".join(chr(0x4E00 + i) for i in range(quality.PART))
    good, bad = ["".join(chr(a + i % 50) for i in range(3000)) for a in (0x5000, 0x6000)]
    table = words.WordTable(quality.word_features, quality.HASHED + quality.SHAPES)
    bags, sizes = quality.encode(table, [start + good, start + bad, "a b"])
    assert sizes.tolist() == [2, 2, 1]  # 3,040 characters are 76 pieces of PART, 64 to a passage
    assert not np.allclose(bags[:2], bags[2:4])
    sample = [(start + (good if i % 2 else bad)[i:], i % 2) for i in range(60)]
    scores, predicted = quality._scorer(quality.fit(sample[:40]), 0.5)([t for t, _ in sample[40:]])
    assert predicted.tolist() == [y for _, y in sample[40:]]


def spec_quality(model, text):
    """A text's score by the docstring, a word and a passage at a time."""
    own = [w[k : k + quality.PART] for w in (text or "").split() for k in range(0, len(w), quality.PART)]
    bags = [own[k : k + quality.PASSAGE] for k in range(0, len(own), quality.PASSAGE)] or [[]]
    width, raw, rows = quality.HASHED + quality.SHAPES, [], []
    for bag in bags:
        features = [quality.word_features([w])[0].astype(float) for w in bag]
        mean = np.sum(features, axis=0) / len(bag) if bag else np.zeros(width)
        h = (np.array([*mean, len({*bag}) / max(len(bag), 1), len(bag) / quality.PASSAGE]) - model.mean) / model.spread
        rows.append(h)
        raw.append(float((np.tanh(h @ model.v) / (1 + np.exp(-(h @ model.u)))) @ model.w))
    weight = np.exp(np.array(raw) - max(raw))
    pooled = (weight / weight.sum()) @ np.array(rows)
    return 1 / (1 + np.exp(-(pooled @ model.head + model.bias[0])))


def spec_toxicity(model, text):
    """Mean over words of the mean of their buckets' projections."""
    logits = []
    for w in (text or "").split():
        core = w.lower().strip("".join({c for c in w if not c.isalnum()}) or None)
        marked = f"<{core}>".encode()
        grams = [zlib.crc32(marked)] + [zlib.crc32(marked[i : i + n], 7) for n in (3, 4, 5) for i in range(len(marked) - n + 1)]
        logits.append(np.mean([float(model.projected[g % toxicity.BUCKETS]) for g in grams]))
    return 1 / (1 + np.exp(-(sum(logits) / max(len(logits), 1) + model.bias)))


AWKWARD = [None, "", " \n\t", "x", "Hello!! WORLD?? 123", "中文" * 5000, "é" * 300 + " scum", "idiot " * 4000, "mor0n ,scum. tie tie", "mor0n ,scum. tie tie"]


def test_quality_and_toxicity_by_brute_force(spark):
    sample = [(" ".join(np.random.default_rng(i).choice(["river", "STONE!!", "idiot", "moon", "a1"], 90)) + (" scum IDIOT!!" if i % 2 else ""), i % 2) for i in range(60)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(AWKWARD)], "doc_id long, text string, score int")
    for module, spec in ((quality, spec_quality), (toxicity, spec_toxicity)):
        model = module.fit(sample)
        got = {r.doc_id: r for r in module.score(df.select("doc_id", "text"), model).collect()}
        for i, text in enumerate(AWKWARD):
            assert abs(got[i].score - spec(model, text)) < 1e-4 and got[i].predicted == int(got[i].score >= module.THRESHOLD), (module.__name__, i)


def test_models_on_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = public_tokenizers.path("piece_bpe_32k.model")
    assert quality.classify(none, labels).count() == toxicity.classify(none, labels).count() == language.identify(none, path).count() == language.keep_identified(none, path).count() == 0
    assert near_dedup.drop_near_duplicates(none).count() == secrets.redact(none).count() == 0


def test_language_learns_from_long_words_and_rejects_chance(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rng = np.random.default_rng(3)
    own = {"en": ["the", "house", "water", "town", "with"], "xx": ["zukar", "mobelin", "trasko", "venudi"]}
    rows = [(i, "".join(rng.choice(own[lang], 60)) if lang == "xx" else " ".join(rng.choice(own[lang], 60)), lang, i) for i, lang in enumerate(["en", "xx"] * 20)]
    chance = "".join(rng.choice([*"bcdfghjklmnpqrstvwxz"], 400))
    df = spark.createDataFrame([*rows, (90, chance, None, 1), (91, "the house with water", None, 2), (91, "the house with water", None, 2), (92, None, "en", 3)], "doc_id long, text string, lang string, score int")
    got = {r.doc_id: r.lang_pred for r in language.identify(df, path).collect()}
    assert all(got[i] == lang for i, _, lang, _ in rows)  # words of several hundred letters are learnt from too
    kept = language.keep_identified(df, path)
    assert kept.columns == df.columns
    assert Counter((r.doc_id, r.lang) for r in kept.collect()) == Counter([(i, lang) for i, _, lang, _ in rows] + [(91, "en")] * 2)


def test_fold_is_crc32(spark):
    got = spark.range(50).select("id", words.fold(F.col("id"), 5, 0).alias("h")).collect()
    assert all(r.h == (zlib.crc32(str(r.id).encode()) % 5 == 0) for r in got)


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(600, 16)) * rng.uniform(0.5, 2, (600, 1))
    x[300:] = x[300]
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(1000, None), (1020, [0.0] * 16), (1040, [float("nan")] * 16), (1060, [1.0] * 3), (None, [1.0] * 16), (0, x[0].tolist()), (1080, [None] * 16)]
    got = neighbours.nearest(spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")).collect()
    by = defaultdict(list)
    for r in sorted(got, key=lambda r: r.rank):
        by[r.query_id].append((r.vec_id, r.score))
    assert set(by) == set(range(0, 600, 20)) and all(len(v) == 20 for v in by.values())
    hits = 0
    for q, found in by.items():
        s = (x * x[q]).sum(1)
        s[q] = -np.inf
        best = np.lexsort((np.arange(600), -s))[:20]
        hits += len({*best} & {i for i, _ in found})
        assert all(abs(s[i] - v) < 1e-12 for i, v in found) and found == sorted(found, key=lambda f: (-f[1], f[0]))
    assert hits / (20 * len(by)) >= 0.9
    assert neighbours.nearest(spark.createDataFrame(odd[:4], "vec_id long, embedding array<double>").where("vec_id = 1000")).count() == 0


def test_neighbours_of_extreme_vectors(spark):
    huge, tiny = ([(i, [s * 10.0 ** (e + i % 3)] * 4) for i in range(40)] for e, s in ((199, 1), (-201, 1)))
    for rows in (huge, tiny, [(i, [1e200, -1e200, 1e200, -1e200] if i % 2 else [1e200] * 4) for i in range(40)]):
        got = defaultdict(list)
        for r in neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), share=1e9).sort("rank").collect():
            got[r.query_id].append((r.vec_id, r.score))
        x = np.array([v for _, v in rows])
        for q, found in got.items():
            with np.errstate(all="ignore"):
                s = (x * x[q]).sum(1)
            best = [i for i in np.lexsort((np.arange(40), -np.where(np.isnan(s), 0, s), np.isnan(s))) if i != q][:20]
            assert [i for i, _ in found] == best and [repr(v) for _, v in found] == [repr(float(s[i])) for i in best]
        assert {*got} == {0, 20}


def test_neighbours_are_all_there_in_small_tables():
    for n in (1, 2, 15, 30, 60):
        x = np.random.default_rng(n).normal(size=(n, 8))
        hashes = neighbours.Hashes(x if n > 1 else np.repeat(x, 2, 0), np.sqrt((x * x).sum(1)).max())
        found = neighbours.search(hashes, np.arange(n), x, np.arange(n), x, 20, 0.01)
        assert [int((found[0] == i).sum()) for i in range(n)] == [min(20, n - 1)] * n


def test_neighbours_reach_the_recall_at_several_sizes():
    for n in (400, 3000):
        rng = np.random.default_rng(n)
        x = rng.normal(size=(n, 64))
        x /= np.sqrt((x * x).sum(1))[:, None]
        hashes, ids, q = neighbours.Hashes(x, 1.0), np.arange(n), np.arange(0, n, 20)
        found = neighbours.search(hashes, ids, x, q, x[q], 20, neighbours.CANDIDATES)
        hits = 0
        for i in q:
            s = x @ x[i]
            s[i] = -np.inf
            hits += len({*np.argsort(-s)[:20]} & {*found[1][found[0] == i]})
        assert hits / (20 * len(q)) >= 0.9
        few = neighbours.search(hashes, ids, x, q, x[q], 20, 0.1)  # the forest decides: a small share finds less
        assert n < 1000 or not np.array_equal(few[1], found[1])


@pytest.mark.parametrize("run", [exact_dedup.duplicate_groups, exact_dedup.drop_duplicates, near_dedup.near_duplicates, secrets.digests, line_dedup.drop_lines, lambda d: bpe.encode_digests(d, public_tokenizers.path("byte_bpe_50k.json"))])
def test_empty_tables(docs, run):
    assert run(docs.limit(0)).count() == 0


@pytest.mark.parametrize("run", [secrets.digests, line_dedup.drop_lines, secrets.redact])
def test_awkward_rows_are_all_kept(docs, run):
    assert run(docs).count() == len(ROWS)
