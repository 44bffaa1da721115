import json

import pytest
from pyspark.sql import functions as F

from litengine.config import MiningConfig, load_env, parse_bool
from litengine.operators import assertions as AS
from litengine.operators import literature as LI
from litengine.operators import reconcile as RE
from litengine.operators import report as RP
from litengine.operators import tagging as TG
from litengine.operators import validate as VA
from litengine.plans import pipeline as PL

MENTIONS = "etype string, origin string, name string"
VERDICTS = "chunk_no int, confirmed array<string>, uncertain array<string>, rejected array<string>, not_assessed array<string>, notes string, error string"


def test_buckets_and_double_membership(spark):
    rows = [("gene", "abstract", "A"), ("gene", "curated", "A"), ("gene", "full_text", "B"), ("gene", "curated", "B"), ("variant", "abstract", "v"), ("gene", "abstract", "A")]
    got = {(r["bucket"], r["name"]) for r in RE.buckets(spark.createDataFrame(rows, MENTIONS)).collect()}
    assert got == {("genes_in_both_abstract_clinvar", "A"), ("genes_only_clinvar", "B"), ("genes_only_full_text", "B"), ("variants_only_text", "v")}


def test_bucket_algebra(spark, sf):
    from litengine.plans.queries import _mentions

    p = RE.presence(_mentions(spark, sf)).filter("etype = 'gene'").agg(F.count_if("a"), F.count_if(F.col("a") & F.col("c")), F.count_if(F.col("a") & ~F.col("c"))).first()
    assert p[0] == p[1] + p[2] > 0


def test_no_abstract_no_mention(spark):
    df = spark.createDataFrame([("1", None, "<a><b>p.G12C</b></a>"), ("2", "", "<a><b>p.G12C</b></a>"), ("3", "XYZ1 here", "<a><b>p.G12C</b></a>")], "pmid string, abstract string, pmc_xml string")
    assert {r["pmid"] for r in LI.mentions(df).collect()} == {"3"}
    plain = {(r["origin"], r["name"]) for r in LI.mentions(df, "plain").collect()}
    assert ("full_text", "p.G12C") in plain


def test_first_link(spark):
    links = spark.createDataFrame([("1", "20", 2), ("1", "10", 1), ("1", "10", 1), (None, "9", 1)], "pmid string, pmc_numeric_id string, link_rank int")
    arts = spark.createDataFrame([("1",), ("2",)], "pmid string")
    assert {tuple(r) for r in LI.resolve_ids(arts, links).collect()} == {("1", "PMC10"), ("2", None)}


def test_tagged(spark):
    df = spark.createDataFrame([("gene", "ABC", 0.75), ("gene", "ABC", 0.74), ("Gene", "ABC", 1.0), ("gene", "abc", 1.0), ("gene", None, 1.0), ("gene", "ABC", None)], "etype string, name string, score double")
    assert LI.tagged_genes(df).count() == 1
    texts = spark.createDataFrame([("BRCA2 and BRCA2, not brca",), (None,)], "t string")
    assert [r["name"] for r in TG.labels(texts, "t").collect()] == ["BRCA2", "BRCA2"]


def record(**change):
    base = {
        "uid": "7", "variation_set": [{"measure_id": 5, "variation_name": "NM_1.1(AB):c.1A>G", "aliases": "x", "variation_loc": [{"assembly_name": "GRCh37", "chr": "1", "start": 5}, {"assembly_name": "GRCh38", "chr": 2}]}],
        "genes": [{"symbol": None, "GeneID": 1}, {"symbol": "A", "GeneID": "2"}], "germline_classification": {"description": "Benign", "trait_set": {"trait_name": "t", "trait_xrefs": [{"db_source": "D", "db_id": 3}, {"db_id": "4"}]}},
    }
    return base | change


def test_parse_and_flatten(spark):
    new = {"uid": "8", "genes": {"gene": [{"symbol": "B", "gene_id": "9"}]}, "clinical_significance": json.dumps({"description": "X", "traits": [{"trait_name": "u", "trait_xrefs": {"db": "E", "id": "1"}}]})}
    payloads = [json.dumps(record()), json.dumps(json.dumps(new)), json.dumps([record(uid="9", genes=None)]), "{broken", None]
    raw = spark.createDataFrame([(i, p, None) for i, p in enumerate(payloads)], "raw_id long, payload string, loaded_at timestamp")
    flat = {r["raw_id"]: r for r in AS.flatten_parsed(AS.parse_nested(raw)).collect()}
    assert set(flat) == {0, 1, 2}
    r = flat[0]
    assert (r["genes"], r["gene_ids"], r["aliases"], r["measure_id"]) == ("None, A", "1, 2", "x", "5")
    assert (r["chr38"], r["chr37"], r["start37"], r["start38"]) == ("2", "1", "5", None)
    assert r["trait_ids"] == "D:3, None:4"
    assert (flat[1]["genes"], flat[1]["trait_ids"], flat[1]["clinical_significance"]) == ("B", "E:1", "X")
    assert flat[2]["genes"] is None
    assert tuple(flat[0].asDict())[1:] == AS.FLAT_COLUMNS


def test_significance_exact(spark):
    df = spark.createDataFrame([("Pathogenic",), ("Likely pathogenic",), ("Pathogenic/Likely pathogenic",), (None,), ("pathogenic",)], "clinical_significance string")
    assert AS.significant(df, ("Pathogenic", "Likely pathogenic")).count() == 2


def test_chunks(spark):
    items = spark.createDataFrame([(k, "genes_only_abstract", 2, i, "X" * (4 * (i % 5) + 1)) for k in (1, 2) for i in range(40)], "run_id int, bucket string, bucket_ord int, pos int, item string")
    got = VA.pack(items, 120).collect()
    for k in (1, 2):
        mine = sorted((r for r in got if r["run_id"] == k), key=lambda r: r["pos"])
        used, ids = 0, []
        for r in mine:
            if used and used + r["cost"] > 120:
                used, ids = 0, [*ids, (ids[-1] if ids else 0) + 1]
            else:
                ids.append(ids[-1] if ids else 0)
            used += r["cost"]
        assert [r["chunk_id"] for r in mine] == ids


def test_merge(spark):
    rows = [(0, ["b", "a"], [], ["x"], [], "one.", None), (1, None, None, None, None, None, "timeout"), (2, ["a"], ["x"], [], ["z"], "two.", None)]
    m = VA.merge(spark.createDataFrame(rows, VERDICTS)).first()
    assert (m["chunk_count"], m["successful_chunks"], m["confirmed"], m["notes"]) == (3, 2, ["a", "b"], "one | two")
    failed = VA.merge(spark.createDataFrame([(0, None, None, None, None, None, None)], VERDICTS)).first()
    assert failed["notes"] == VA.ALL_FINE
    assert failed["confirmed"] == []


def test_status_precedence(spark):
    v = spark.createDataFrame([(0, ["A"], [], ["G"], ["N"], "", None), (1, [], [], ["A"], [], "", None)], VERDICTS)
    names = spark.createDataFrame([("gene", "A"), ("gene", "N"), ("variant", "NM_1.1(G):c.1A>G"), ("variant", "rs1")], "etype string, name string")
    got = {r["name"]: r["status"] for r in VA.with_status(names, v, is_variant=F.col("etype") == "variant").collect()}
    assert got == {"A": "Confirmed", "N": "Not assessed", "NM_1.1(G):c.1A>G": "Rejected", "rs1": "Not assessed"}


def flaky(query, chunk):
    raise ValueError("401 unauthorized")


def test_pipeline_and_report(spark, tmp_path):
    arts = spark.createDataFrame([("1", "t", "BRCA2 and rs123 here", None, None)], "pmid string, title string, abstract string, pmcid string, pmc_xml string")
    recs = spark.createDataFrame([("7", "BRCA2, TP53", "NM_1.1(BRCA2):c.1A>G", "Pathogenic")], "uid string, genes string, variation_name string, clinical_significance string")
    cfg = MiningConfig(disease_term="d")
    mined = PL.mine(arts, recs, cfg)
    s = mined.summary.first()
    assert (s["total_articles_found"], s["genes_from_literature"], s["total_unique_genes"], s["clinvar_pathogenic_variants"]) == (1, 1, 2, 1)
    verdict = PL.validated(mined, cfg, VA.stub_validator)
    v = verdict.first()
    assert v["confirmed"] == ["BRCA2"]
    assert v["mode"] == "single"
    rep = PL.run_report(mined, cfg, verdict)
    assert "Perplexity Status" in rep.columns
    assert "Perplexity Status" not in PL.run_report(mined, cfg).columns
    RP.emit(rep, "d", None, str(tmp_path / "r.csv"))
    assert (tmp_path / "r.csv").read_text().startswith("Entity Type,Entity Name,Associated Gene,Source,Perplexity Status,Notes\nGene,BRCA2,,Both,Confirmed,")
    RP.emit(rep, "d", {"error": "x"}, str(tmp_path / "r.txt"))
    text = (tmp_path / "r.txt").read_text()
    assert "Total entities: 4" in text
    assert '"error": "x"' in text
    chunks = spark.createDataFrame([(0, "genes_only_abstract", "A")], "chunk_id int, bucket string, item string")
    assert VA.validate(chunks, "q", flaky, wait=lambda s: None).first()[1:] == (None, "ValueError: 401 unauthorized")


def test_empty_sources(spark):
    arts = spark.createDataFrame([], "pmid string, title string, abstract string, pmcid string, pmc_xml string")
    recs = spark.createDataFrame([], "uid string, genes string, variation_name string, clinical_significance string")
    mined = PL.mine(arts, recs)
    assert mined.buckets.count() == 0
    assert mined.summary.count() in (0, 1)


def test_config(tmp_path, monkeypatch):
    with pytest.raises(ValueError, match="Bad"):
        MiningConfig(clinical_relevance=("Bad",)).checked()
    assert parse_bool("On")
    assert not parse_bool("no")
    (tmp_path / ".env").write_text("LITENGINE_X=1\n# c\n")
    monkeypatch.delenv("LITENGINE_X", raising=False)
    assert load_env(str(tmp_path / ".env")) == 1


def test_cli(monkeypatch):
    from litengine.cli import config

    cfg, _ = config(["-q", "x", "-e", "a@b.c", "--enable-chunking", "no"])
    assert (cfg.retmax, cfg.enable_chunking) == (10, False)
    monkeypatch.delenv("PERPLEXITY_API_KEY", raising=False)
    with pytest.raises(ValueError, match="not set"):
        config(["-q", "x", "-e", "a@b.c", "-p"])


BUILT = []


def counted_tagger(label):
    BUILT.append(label)
    return lambda text: [(w, "Gene", 0.9 if w != "LOW1" else 0.1) for w in text.split()] + [("XX9", label, 1.0)]


def test_a_tagger_is_loaded_once_for_each_of_its_parameters():
    import functools

    from litengine.operators import tagging as TG

    BUILT.clear()
    for label in ("Gene", "Gene", "Other", "Gene"):
        TG.loaded(functools.partial(counted_tagger, label))
    assert BUILT == ["Gene", "Other"]


def test_mining_with_a_tagger(spark):
    import functools

    arts = spark.createDataFrame([("1", "AB1 LOW1 low", None), ("2", None, "<a><b>CD2</b></a>"), ("3", "AB1", "<a><b>EF3</b></a>"), ("3", "AB1", "<a><b>EF3</b></a>")], "pmid string, abstract string, pmc_xml string")
    recs = spark.createDataFrame([], "uid string, genes string, variation_name string, clinical_significance string")
    mined = PL.mine(arts, recs, MiningConfig(min_score=0.5), functools.partial(counted_tagger, "Other"))
    assert {(r["bucket"], r["name"]) for r in mined.buckets.collect()} == {("genes_only_abstract", "AB1")}  # markup is no acronym
    plain = PL.mine(arts, recs, MiningConfig(min_score=0.5, full_text_mode="plain"), functools.partial(counted_tagger, "Other"))
    assert ("genes_only_full_text", "EF3") in {(r["bucket"], r["name"]) for r in plain.buckets.collect()}
    assert {(r["name"]) for r in PL.mine(arts, recs, MiningConfig(min_score=0.05), functools.partial(counted_tagger, "Gene")).buckets.collect()} >= {"LOW1", "XX9"}


def test_search_terms(spark):
    assert LI.parsed_terms(' AND (genetics OR "gene x") AND b') == (("genetics", "gene x"), ("b",))
    assert LI.parsed_terms("") == ()
    with pytest.raises(ValueError, match="another form"):
        LI.parsed_terms("a NOT b")
    df = spark.createDataFrame([(1, "X with Genetics"), (2, "x alone"), (3, None)], "r int, t string")
    assert [r["r"] for r in LI.search_top(df, F.col("t"), (("x",), *LI.parsed_terms(" AND (genetics OR variant)")), [F.col("r")], 5).collect()] == [1]


def test_text_report_looks_as_a_table_does(spark):
    rows = [("Gene", "A", "", "Both", "n1", 1), ("Variant", "c.1A>G, \"q\"", "c.1A>G", "Full Text Only", "note two", 7)]
    rep = spark.createDataFrame(rows, "`Entity Type` string, `Entity Name` string, `Associated Gene` string, Source string, Notes string, bucket_ord int")
    lines = list(RP.text_lines(rep, "d"))
    assert lines[3:-2] == RP.ordered(rep).toPandas().to_string(index=False).split("\n")
    assert lines[-1] == "Total entities: 2"


def test_failed_chunks_do_not_hold_up_others(spark):
    """Five chunks, three places: the verdicts of all, whatever fails."""
    chunks = spark.createDataFrame([(i, "b", f"N{i}") for i in range(5)], "chunk_id int, bucket string, item string")
    got = {r["chunk_id"]: (r["verdict"], r["error"]) for r in VA.validate(chunks, "q", half, 3, 2, wait=lambda s: None).collect()}
    assert {k for k, (v, _) in got.items() if v} == {1, 3}
    assert all("429" in e for v, e in got.values() if not v)


def half(query, chunk):
    if int(chunk["b"][0][1:]) % 2 == 0:
        raise RuntimeError("HTTP 429")
    return "{}"
