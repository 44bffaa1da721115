import json

import pytest

from litengine.sources import entrez, retry
from litengine.sources.xmlshred import article_fields

XML = """<PubmedArticleSet><PubmedArticle><MedlineCitation><PMID>2</PMID><Article><ArticleTitle>T <i>k</i></ArticleTitle><Abstract><AbstractText>pre <i>in</i> post</AbstractText>
<AbstractText>two</AbstractText></Abstract></Article></MedlineCitation></PubmedArticle><PubmedArticle><MedlineCitation/></PubmedArticle></PubmedArticleSet>"""


def transport(endpoint, params):
    if endpoint == "esearch":
        return json.dumps({"esearchresult": {"idlist": ["2", "1"] if params["term"] else []}})
    if endpoint == "efetch":
        return XML
    return json.dumps({"result": {"2": {"title": "a"}}})


def test_leading_text(spark):
    df = spark.createDataFrame([(XML,), ("<broken",), (None,)], "x string")
    assert [tuple(r) for r in article_fields(df, "x").collect()] == [("2", "T ", "pre  two")]
    assert article_fields(df, "x", "full").first()["abstract"] == "pre in post two"


def test_data_source(spark):
    entrez.register(spark)
    got = spark.read.format("litengine_articles").option("term", "x").option("transport", "tests.test_sources:transport").load().collect()
    assert [(r["rank"], r["pmid"]) for r in got] == [(0, "2")]
    rows = spark.read.format("litengine_assertions").option("term", "x").option("transport", "tests.test_sources:transport").load().collect()
    assert [(r["rank"], r["uid"]) for r in rows] == [(0, "2")]
    assert spark.read.format("litengine_articles").option("term", "").option("transport", "tests.test_sources:transport").load().count() == 0


ARTICLE = "<PubmedArticle><MedlineCitation><PMID>{}</PMID></MedlineCitation><ArticleTitle>T</ArticleTitle><Abstract><AbstractText>{}</AbstractText></Abstract></PubmedArticle>"
SUMMARY = {
    "variation_set": [{"variation_name": "NM_1.1(BRCA2):c.1A>G", "variation_loc": [{"assembly_name": "GRCh38", "chr": "13"}]}], "genes": [{"symbol": "BRCA2", "GeneID": "675"}, {"symbol": "TP53", "GeneID": "7157"}],
    "germline_classification": {"description": "Pathogenic", "trait_set": [{"trait_name": "d", "trait_xrefs": [{"db_source": "X", "db_id": "1"}]}]},
}
ASKED = []


def remote(endpoint, params):
    """Three articles: one with a full text, one whose full text is broken, one without a link."""
    ASKED.append((endpoint, dict(params)))
    assert params["email"] == "me@example.org"
    if endpoint == "esearch":
        assert params["term"] == ("d AND (genetics OR variant)" if params["db"] == "pubmed" else "d")
        return json.dumps({"esearchresult": {"idlist": ["1", "2", "3"] if params["db"] == "pubmed" else ["900"]}})
    if endpoint == "elink":
        sets = [{"ids": [i], "linksetdbs": [{"linkname": "pubmed_pmc", "links": [f"{i}1", f"{i}2"]}]} for i in params["id"] if i != "3"] + [{"ids": ["3"]}]
        return json.dumps({"linksets": sets})
    if endpoint == "esummary":
        return json.dumps({"result": {"uids": ["900"], "900": SUMMARY}})
    if params["db"] == "pmc":
        return "<article><body>MLH1 and c.5del</body></article>" if params["id"] == "11" else "<article><body>"
    if params["db"] == "clinvar":
        return "<ClinVarResult-Set><VariationArchive/></ClinVarResult-Set>" if params["id"] == "900" else "<cut"
    return "<PubmedArticleSet>" + ARTICLE.format(1, "BRCA2 and rs123 here") + ARTICLE.format(2, "KRAS") + ARTICLE.format(3, "") + "</PubmedArticleSet>"


REMOTE = {"email": "me@example.org", "transport": "tests.test_sources:remote"}


def test_literature_composite(spark):
    from litengine.config import MiningConfig
    from litengine.plans import pipeline as PL

    got = {r["pmid"]: r for r in PL.fetch_literature(spark, MiningConfig(disease_term="d"), REMOTE).collect()}
    assert {k: (r["pmcid"], bool(r["pmc_xml"])) for k, r in got.items()} == {"1": ("PMC11", True), "2": ("PMC21", False), "3": (None, False)}
    flat = PL.fetch_assertions(spark, MiningConfig(disease_term="d"), REMOTE).collect()
    assert [(r["rank"], r["uid"], r["genes"], r["trait_ids"], r["clinical_significance"], r["chr38"]) for r in flat] == [(0, "900", "BRCA2, TP53", "X:1", "Pathogenic", "13")]
    assert not [r for r in PL.fetch_literature(spark, MiningConfig(disease_term="d"), REMOTE, full_text=False).collect() if r["pmcid"]]


def test_full_records(spark):
    entrez.register(spark)
    rows = spark.read.format("litengine_assertion_records").options(**REMOTE).option("term", "d").load().collect()
    assert [(r["uid"], "VariationArchive" in r["record_xml"]) for r in rows] == [("900", True)]


def test_lookups_survive_failures(spark):
    ids = spark.createDataFrame([("7",), ("7",), (None,)], "pmid string")
    assert entrez.links(ids, {"transport": "tests.test_sources:broken", "max_retries": "1"}).count() == 0
    assert entrez.full_texts(ids, {"transport": "tests.test_sources:broken", "max_retries": "1"}, "pmid").count() == 0


def broken(endpoint, params):
    raise ValueError("401")


def post(body, headers, seconds):
    assert headers["Authorization"] == "Bearer k"
    assert (body["model"], body["temperature"], body["max_tokens"]) == ("sonar", 0.1, 99)
    assert body["response_format"]["json_schema"]["schema"]["required"][-1] == "notes"
    return json.dumps({"choices": [{"message": {"content": ' {"confirmed": ["BRCA2"], "uncertain": [], "rejected": ["TP53"], "not_assessed": [], "notes": "ok."} '}}]})


def test_remote_validator():
    from litengine.sources.validator import RemoteValidator

    v = RemoteValidator("sonar", 0.1, 99, "k", "tests.test_sources:post")
    assert json.loads(v("d", {"genes_only_clinvar": ["BRCA2"]}))["confirmed"] == ["BRCA2"]


def judge(query, chunk):
    names = [n for ns in chunk.values() for n in ns]
    assert query == "d"
    return json.dumps({"confirmed": [n for n in names if n == "BRCA2"], "uncertain": [], "rejected": ["TP53"], "not_assessed": [], "notes": "ok."})


@pytest.mark.parametrize("flags", [[], ["-p", "--validator", "tests.test_sources:judge"], ["-p", "--validator", "tests.test_sources:nothing_here"]])
def test_command_line(spark, tmp_path, flags):
    """From remote answers to the report, without a table and without a stub."""
    from litengine import cli

    out = tmp_path / "r.csv"
    assert cli.main(["-q", "d", "-e", "me@example.org", "--transport", "tests.test_sources:remote", "--tagger", "pattern", "-o", str(out), *flags]) == 0
    rows = [line.split(",") for line in out.read_text().splitlines()]
    names = {r[1]: r for r in rows[1:]}
    assert {"BRCA2", "TP53", "KRAS", "MLH1", "rs123", "c.5del", "NM_1.1(BRCA2):c.1A>G"} == set(names)
    if "tests.test_sources:judge" in flags:
        assert [names[n][4] for n in ("BRCA2", "TP53", "KRAS", "NM_1.1(BRCA2):c.1A>G")] == ["Confirmed", "Rejected", "Not assessed", "Confirmed"]
    else:  # a validator that can't be had leaves no status behind
        assert "Perplexity Status" not in rows[0]


def test_no_key_no_work(monkeypatch):
    from litengine import cli

    monkeypatch.delenv("PERPLEXITY_API_KEY", raising=False)
    assert cli.main(["-q", "d", "-e", "x", "-p"]) == 1


def test_retry():
    waits, calls = [], []

    def fails():
        calls.append(1)
        raise OSError("timeout")

    with pytest.raises(OSError, match="timeout"):
        retry.retrying(fails, 3, 2.0, wait=waits.append)
    assert len(calls) == 3
    assert 2 <= waits[0] <= 3
    assert 4 <= waits[1] <= 5

    def wrong():
        calls.append(1)
        raise ValueError("401")

    with pytest.raises(ValueError, match="401"):
        retry.retrying(wrong, 3, wait=waits.append)
    assert len(calls) == 4
