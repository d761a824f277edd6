from public_tokenizers import path
from tokenizers import Tokenizer

from tabularium.llm import bpe


def test_no_sample_of_the_documents_is_taken(spark, monkeypatch):
    def never(*_):
        raise AssertionError("a sample")

    monkeypatch.setattr(bpe, "frequent_runs", never)
    file = path("byte_bpe_50k.json")
    texts = {1: "tick tock tick", 2: None, 3: "Ünïcodé a1,b  zzqx"}
    docs = spark.createDataFrame([*texts.items()], "doc_id long, text string")
    got = {r.doc_id: r.ids for r in bpe.encode(docs, file).collect()}
    library = Tokenizer.from_file(file)
    assert got == {i: library.encode(t or "", add_special_tokens=False).ids for i, t in texts.items()}
