"""What a Python worker of a pipeline stage holds at once."""

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql.types import StructType

from tabularium.llm import common, language, near_dedup, packing, words


class Frame:
    """Stands for a DataFrame of one partition: runs what ``mapInArrow`` gets on one large batch."""

    def __init__(self, batch, session):
        self.batch, self.sparkSession, self.columns = batch, session, batch.schema.names
        self.schema = StructType.fromDDL("doc_id long, text string, lang string")

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return [*run(iter([self.batch]))]


def test_stages_hold_a_part_of_a_batch(spark, monkeypatch):
    n = 2 * common.PART_ROWS + 7
    texts = [f"wort{i % 50} haus" if i % 3 else "12" for i in range(n)]
    frame = Frame(pa.RecordBatch.from_arrays([pa.array(range(n), pa.int64()), pa.array(texts), pa.array([None] * n, pa.string())], names=["doc_id", "text", "lang"]), spark)
    model = language.Model(["de"], np.zeros(1), ["▁haus", "wort", "▁wort"], np.array([[0.4], [0.3], [0.3], [0.0], [language.UNKNOWN]]))
    monkeypatch.setattr(language, "fit", lambda *a: model)
    ways = {
        "language": lambda: language.keep_identified(frame, "unused"), "near": lambda: near_dedup.fingerprints(frame), "packing": lambda: packing.token_pieces(frame, public_tokenizers.path("word_bpe_49k.json")),
    }
    for name, way in ways.items():
        made = way()
        assert max(b.num_rows for b in made) <= common.PART_ROWS, name
        ids = [i for b in made for i in b.column("doc_id").to_pylist()]
        assert ids == [i for i in range(n) if name != "language" or i % 3], name


def test_word_table_of_a_stage_is_bounded():
    table = words.WordTable(lambda new: np.array([[len(w)] for w in new]), 1, most=10)
    for k in range(50):
        assert table.take([f"{k}", "abc"])[:, 0].tolist() == [len(str(k)), 3]
        assert len(table.index) <= 12
