"""The pipeline on the smallest tables: every stage's decisions, and what must stay."""

from __future__ import annotations

import corpus_pipeline
from tickloom.llm import near_dedup, source_mixing
from tickloom.llm.common import materialize, table

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, SF, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF))
        assert docs.columns == columns
        seen[name] = docs
    letters = table(spark, SF, "documents").where("text rlike '[A-Za-z]'").count()
    assert seen["language_id"].count() == letters
    assert seen["near_dedup"].count() == near_dedup.near_duplicates(seen["language_id"]).where("kept").count()
    assert seen["suffix_dedup"].count() == seen["near_dedup"].count()
    items = [r.text.lower() for r in table(spark, SF, "benchmark").collect()]
    assert not [1 for r in seen["decontamination"].collect() for i in items if i in r.text.lower()]
    sizes = source_mixing.mix_report(seen["decontamination"]).toPandas()
    assert abs(sizes["taken"].sum() - 1.5 * sizes["size"].sum()) < 0.05 * sizes["size"].sum()


def test_stages_of_odd_tables(spark, tmp_path):
    """Nulls, empty and long texts, repeated rows, ties and clashing columns; and an empty table."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, label string, node string, row string, kept string"
    first = table(spark, SF, "documents").orderBy("doc_id").limit(30).collect()
    rows = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, "x", "x", "x", "x") for r in first]
    rows += [(None, None, None, None, None, *"xxxx"), (None, "", None, None, 0, *"xxxx"), (900, first[0].text * 40, "en", None, None, *"xxxx"), rows[1], rows[1], (901, rows[2][1], *rows[2][2:])]
    docs = spark.createDataFrame(rows, schema)
    for name, frame in (("odd", docs), ("none", docs.limit(0))):
        folder = tmp_path / name
        frame.write.parquet(str(folder / "documents.parquet"))
        table(spark, SF, "benchmark").write.parquet(str(folder / "benchmark.parquet"))
        now, counts = frame, []
        for _, stage in corpus_pipeline.STAGES:
            now = materialize(stage(spark, now, str(folder)))
            assert now.columns == docs.columns
            counts.append(now.count())
        assert corpus_pipeline.run(spark, str(folder)).count() == counts[-1]
        assert counts == [0] * 5 if name == "none" else counts[0] >= counts[1] == counts[2] >= counts[3] > 0
