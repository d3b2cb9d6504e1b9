"""The corpus pipeline against the stages' brute-force versions."""

import public_tokenizers as public
import tiktoken

import corpus_pipeline
from docweave.llm import byte_bpe, common, language_id, pii
from tests.llm import test_decontaminate, test_minhash_forest, test_pii
from tests.llm.brute import read


def redacted(text):
    """Base spans merged and replaced; only for texts without added kinds."""
    spans = sorted((s, e, k.upper()) for k, s, e in test_pii.brute(text))
    out, at = "", 0
    merged = []
    for s, e, k in spans:
        if merged and s < merged[-1][1]:
            merged[-1] = (merged[-1][0], max(e, merged[-1][1]), merged[-1][2])
        else:
            merged.append((s, e, k))
    for s, e, k in merged:
        out, at = out + text[at:s] + f"[{k}]", e
    return out + text[at:]


def test_pipeline_equals_brute_force(spark):
    d = "/root/testdata/sf0.01"
    rows = read(d, "documents")
    model = language_id.train(common.table(spark, d, "documents"))
    _, _, rejected = language_id.score_texts(model, [r["text"] for r in rows])
    docs = {r["doc_id"]: r["text"] for r, no in zip(rows, rejected, strict=True) if not no}
    docs = {i: docs[i] for i, _, _, kept in test_minhash_forest.brute(list(docs.items()), 5) if kept}
    items = {r["item_id"]: r["text"] for r in read(d, "benchmark")}
    docs = {i: t for i, t in docs.items() if not test_decontaminate.brute(t, items)}
    tik = tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=byte_bpe.load_ranks(public.path("byte_bpe_50k.tiktoken")), special_tokens={})
    want = {i: tik.encode_ordinary(redacted(t)) for i, t in docs.items()}
    got = corpus_pipeline.run(spark, d).collect()
    assert {r["doc_id"]: r["ids"] for r in got} == want
    assert all(r["decodes"] and r["n_tokens"] == len(r["ids"]) for r in got)
    assert 0.7 * len(rows) < len(got) < len(rows)


def test_stages_on_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, lang_rejected double, document_key string, text_before int"
    text = "that is the one of them and the other a@b.c is to be on for it "
    rows = [(1, text * 3, "en", "s", 5, 0.5, "k", 1), (2, text * 3, "en", "s", 5, 0.5, "k", 1), (2, text * 3, "en", "s", 5, 0.5, "k", 1),
            (None, text, None, None, None, None, None, None), (None, None, None, None, None, None, None, None), (7, "", "de", "s", 0, None, None, None)]
    d = "/root/testdata/sf0.001"
    for df in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, df, d)
            if stage is not corpus_pipeline.token_ids:
                assert out.columns == df.columns, name
            assert out.count() <= df.count()
    df = spark.createDataFrame(rows, schema)
    # Rows without an id: text differs, or is null and so like nothing.
    assert sorted((r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, df, d).collect()), key=repr) == [1, 7, None, None]
    words = lambda k: " ".join(f"{k}{i}" for i in range(30))
    again = [(5, words("a"), "z"), (5, words("b"), "y"), (5, words("b"), "x"), (2**63 - 1, words("c"), "w"), (-2**63, words("d"), "v"), (None, words("a"), "u"), (None, words("c"), "t")]
    out = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(again, "doc_id long, text string, lang string"), d).collect()
    assert sorted(tuple(r) for r in out) == sorted([again[0], again[2], again[3], again[4]])
    texts = {r["doc_id"]: r["text"] for r in corpus_pipeline.personal_data(spark, df, d).collect()}
    assert "[EMAIL]" in texts[1] and "@" not in texts[1] and texts[7] == ""
    assert pii.redact(df.select("text")).count() == len(rows)
