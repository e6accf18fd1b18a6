import public_tokenizers
from test_decontaminate import brute as brute_hits
from test_linededup import brute as brute_lines
from test_simhash import brute_groups, brute_print
from tokenizers import Tokenizer

import corpus_pipeline
from portrait.llm import quality


def brute_kept(rows):
    counts = [quality.text_counts(t) for _, t in rows]
    pattern = []
    for c in counts:
        v = dict(zip(quality.COUNTS, c))
        test = lambda rule: eval(rule.replace(" AND ", " and ").replace(" OR ", " or ").replace(" = ", " == ").replace("10 * word_chars BETWEEN 42 * n_words and 65 * n_words", "42 * n_words <= 10 * word_chars <= 65 * n_words"), {}, v)  # noqa: E731, B023, S307
        pattern.append(("".join("b" if test(r.bad) else "g" if test(r.good) else "-" for r in quality.RULES), test(quality.BASE_FAILED)))
    seen = {}
    for p, failed in pattern:
        if not failed:
            seen[p] = seen.get(p, 0) + 1
    model = quality.fit(seen)
    return [not failed and model.posterior[p] >= 0.5 for p, failed in pattern]


def brute_run(rows, items):
    rows = [r for r, k in zip(rows, brute_kept(rows)) if k]
    rows = [(i, kept) for (i, _), (_, _, kept) in zip(rows, brute_lines(rows))]
    least = brute_groups([(i, brute_print(t)) for i, t in rows])
    rows = [r for r, k in zip(rows, least) if r[0] == k]
    rows = [r for r, h in zip(rows, brute_hits([t for _, t in rows], items)) if h[1] == 0]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {i: library.encode(t, add_special_tokens=False).ids for i, t in rows}


def test_run_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    out = corpus_pipeline.run(spark, sf).collect()
    assert {r.doc_id: r.ids for r in out} == brute_run(rows, items)
    assert len(out) > 50 and all(r.n_tokens == len(r.ids) for r in out)


def test_stages_keep_the_columns_and_bear_odd_rows(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    real = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    odd = spark.createDataFrame([(10**6, None, None, None, None), (None, "short", "en", "s", 5), (10**6 + 1, "", None, "s", 0), (10**6 + 2, "word " * 60_000, "en", "s", 1)], real.schema)
    docs = real.union(odd).union(real.limit(3)).selectExpr("*", "'x' AS row", "1 AS kept")
    for empty in (False, True):
        df = docs.limit(0) if empty else docs
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, df, sf)
            path = f"{tmp_path}/{empty}-{k}"
            out.write.parquet(path)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == df.columns, name
                df = spark.read.parquet(path)
                if name == "line dedup" and not empty:
                    assert df.where("n_chars <> length(text)").count() == 0


def test_names_and_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "benchmark decontamination", "bpe encoding"]


def test_last_stage_decodes(spark):
    import hashlib

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = [(1, "Some words, 12 of them: naïve façades?"), (2, ""), (3, None), (4, "word " * 500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.decoded_sha256 for r in corpus_pipeline.bpe_encoding(spark, docs, "").collect()}
    decoded = {i: library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False) for i, t in rows}
    assert got == {i: hashlib.sha256(t.encode()).hexdigest() for i, t in decoded.items()}
