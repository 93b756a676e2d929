"""Stages of the pipeline exchange texts once, whatever the size."""

from tidemark.llm import mixing, quality


def documents(spark):
    name = lambda i: "abcdefghijklmnopqrstuvwxyz"[i % 26] * (1 + i // 26)
    words = [" ".join(f"{name(i)}{name(j)}" for j in range(60)) for i in range(60)]
    rows = [(i, f"{words[i]}\nshared line of all\nlast {name(i)}", "en", f"s{i % 2}", 0) for i in range(60)]
    rows += [(i, rows[0][1], "en", "s0", 0) for i in (0, 0, 70)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")


def plan(frame) -> list[str]:
    return frame._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_clean_computes_features_and_exchanges_texts_once(spark):
    cleaned = quality.clean(documents(spark))
    assert len([x for x in plan(cleaned) if "Generate explode(" in x]) == 1
    texts = {r["doc_id"]: r["text"] for r in cleaned.collect()}
    assert len(texts) == 61 and sum("shared line" in t for t in texts.values()) == 3  # the first of each host and its copy


def test_mix_reads_the_documents_once_after_its_plan(spark):
    docs = documents(spark)
    mixed = mixing.mix(docs)
    # both ways, of rows alone and of repeated rows, read the joined rows from a table
    assert not [x for x in plan(mixed) if "LogicalRDD" in x or "LocalRelation" in x]
    assert mixed.count() > 0
