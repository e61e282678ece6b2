import random

import pytest

from clickweir.llm import language

WORDS = {"aa": "balu tamo riku seno".split(), "bb": "straz krwin zsch pftag".split()}


def prose(lang, pick, n):
    return " ".join(pick.choices(WORDS[lang], k=n))


@pytest.fixture(scope="module")
def model(spark):
    pick = random.Random(1)
    rows = [(i, prose(lang, pick, 50), lang) for i, lang in enumerate(["aa", "bb"] * 20)] + [(99, None, "aa"), (98, "", "bb"), (97, "balu", None)]
    return language.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))


def pages(spark):
    pick, rows = random.Random(2), []
    for i in range(60):
        lang = "ab"[i % 2] * 2
        rows.append((i, f"http://www.{lang}.example.{'org' if i % 3 else lang}/{lang}/p{i}", f'<html lang="{lang}"><script>straz krwin</script><p>{prose(lang, pick, 30)}</p></html>'))
    rows += [(100, "http://www.aa.example.org/aa/1", "<html></html>"), (101, "http://www.bb.example.org/", None), (102, None, None),
             (103, "http://www.aa.example.org/x", f"<p>{prose('bb', pick, 60)}</p>"), (103, "http://www.aa.example.org/x", f"<p>{prose('bb', pick, 60)}</p>")]
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], "page_id long, url string, html string, lang string, host string")


def test_evidence_is_fused(spark, model):
    got = {r["page_id"]: r for r in language.identify(pages(spark), model).collect()}
    assert all(got[i]["lang"] == "ab"[i % 2] * 2 for i in range(60))
    assert got[100]["lang"] == "aa" and got[101]["lang"] == "bb"  # no text: host, segment
    assert got[103]["lang"] == "bb"  # the text outweighs the host
    assert got[102]["lang"] in ("aa", "bb") and all(0 < r["probability"] <= 1 for r in got.values())
    assert language.identify(pages(spark), model).count() == 65


def test_parts_of_addresses(spark):
    urls = ["https://u:p@M.Foo.example.DE:80/fr-x?q", "http://a.b/en/", "mailto:x", None, "http://host"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    rows = df.select(*[c.alias(n) for n, c in language.address(df["url"]).items()]).collect()
    assert tuple(rows[0]) == ("m.foo.example.de", "example.de", "de", "fr") and rows[1]["segment"] == "en"
    assert [r["host"] for r in rows[2:]] == ["", "", "host"]


def test_no_languages_or_pages(spark, model):
    empty = language.fit(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r["lang"] for r in language.identify(pages(spark), empty).collect()} == {None}
    assert language.identify(pages(spark).limit(0), model).count() == 0
