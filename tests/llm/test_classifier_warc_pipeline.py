"""Classifier by held-out accuracy, WARC by round trip, the pipeline by hand."""

import gzip
import os
import random
from html.parser import HTMLParser

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from logtide.llm import ordinal_quality, warc_derivatives
from tests.llm.data import frame, odd_rows, prose

SF_DIR = os.environ.get("LOGTIDE_TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    ratings = ordinal_quality.graded_labels(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    model = ordinal_quality.train(docs, ratings.where("doc_id % 3 > 0"), 3)
    scored = ordinal_quality.score(docs, model).join(ratings.where("doc_id % 3 = 0"), "doc_id").toPandas()
    good = np.array([t[1] >= 0.5 for t in scored.tails])
    assert ((scored.grade == 2) == good).mean() > 0.9
    assert scored[scored.grade == 2].expected_grade.mean() > scored[scored.grade < 2].expected_grade.mean() + 0.5


def test_thresholds_stay_in_order_and_tails_fall():
    rng = np.random.default_rng(0)
    n = 600
    grades = rng.integers(0, 4, n)
    columns = np.concatenate([np.array([g, 10 + rng.integers(0, 5)]) for g in grades])
    model = ordinal_quality.fit_ordinal(columns, np.ones(2 * n), np.arange(0, 2 * n, 2), grades, 16, 4)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(model.weights[:4].astype(float) + model.weights[10:15].mean())
    assert (np.diff(tails, axis=1) <= 0).all()
    assert (np.abs(tails.sum(axis=1) - np.arange(4)) < 0.3).all()


def test_classifier_bears_odd_rows(spark):
    rows = odd_rows()
    ratings = spark.createDataFrame(
        [(6, 1), (8, 0), (8, 2), (10, None), (None, 1), (11, 7)], "doc_id long, grade int"
    )
    model = ordinal_quality.train(frame(spark, rows), ratings, 3)
    found = ordinal_quality.score(frame(spark, rows), model).collect()
    assert len(found) == len(rows)
    blank = [r for r in found if r.doc_id in (3, 4, 5)]
    assert all(r.score == 0 for r in blank)
    empty = ordinal_quality.train(frame(spark, rows), ratings.where("false"), 3)
    assert not empty.weights.any() and len(empty.thresholds) == 2
    assert ordinal_quality.score(frame(spark, []), model).count() == 0


PAGE = (
    '<!DOCTYPE html><html lang="FR"><head><title>A &amp;\n B</title><style>p{}</style>'
    '<script>var t="</p><b>";</script></head><body><!-- no > --><p>Caf&eacute; <b>au</b>'
    ' <a title="x>y">lait</a></p><p>1 < 2</p><br/>end</body></html>'
)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("record", F.lit(1))


def test_derivatives_round_trip(spark, run_dir):
    rows = [(1, "http://a/é\r\nx", PAGE), (2, None, None), (None, "u", ""), (3, "http://b", "x\r\n\r\ny"), (3, "http://b", "x\r\n\r\ny")]
    sources = warc_derivatives.responses(pages(spark, rows))
    made = warc_derivatives.derivatives(sources)
    records = {(r.page_id, r.warc_type): r for r in made.collect()}
    assert made.count() == 2 * len(rows)
    text = records[1, "conversion"].record.split("\r\n\r\n", 1)[1]
    assert text == "Café au lait\n1 < 2\nend"
    assert "title: A & B\r\n" in records[1, "metadata"].record
    assert "language: fr\r\n" in records[1, "metadata"].record
    assert "http-header-content-type: text/html; charset=utf-8\r\n" in records[1, "metadata"].record
    source = {r.page_id: r for r in sources.collect()}
    for (page, kind), r in records.items():
        other = records[page, "metadata" if kind == "conversion" else "conversion"]
        assert r.refers_to == source[page].record_id and r.concurrent_to == other.record_id
        assert r.source_digest == source[page].payload_digest
    warc_derivatives.write_warc(made, run_dir, compression="gzip")
    warc_derivatives.write_warc(made, run_dir + "-plain")
    back = warc_derivatives.read_warc(spark, run_dir + "-plain").collect()
    assert len(back) == 2 * len(rows)
    for r in back:
        assert warc_derivatives.digest(bytes(r.block)) == r.headers["WARC-Block-Digest"]
        assert r.headers["WARC-Refers-To"].startswith("<urn:uuid:")
    assert {r.headers["WARC-Record-ID"] for r in back} == {r.record_id for r in records.values()}


CUSTOM_PAGE = (
    "<html><head><title-bar>bar</title-bar><title>T</title></head><body><p>first</p>"
    "<title-bar>Hi</title-bar><template-card x='1'>card</template-card><style-guide/>"
    "<script-x>a</script-x><noscript-y>b</noscript-y><script>hidden</script-x></script data-x><p>rest of the page</p></body></html>"
)


def test_custom_elements_hide_nothing(spark):
    page = "<body><p>first</p><title-bar>Hi</title-bar><p>rest of the page</p></body>"
    assert warc_derivatives.plain_text(page) == "first\nHi\nrest of the page"
    assert warc_derivatives.plain_text("a<!-->b<!--->c<!-- d --!>e<!-- f -->g") == "a b c e g"
    assert warc_derivatives.title_of(page) == "" and warc_derivatives.title_of(CUSTOM_PAGE) == "T"
    text = "bar\nfirst\nHicardab\nrest of the page"
    made = warc_derivatives.derivatives(warc_derivatives.responses(pages(spark, [(1, "u", CUSTOM_PAGE)])))
    records = {r.warc_type: r for r in made.collect()}
    assert records["conversion"].record.split("\r\n\r\n", 1)[1] == text
    assert records["conversion"].content_length == len(text)
    assert records["conversion"].block_digest == warc_derivatives.digest(text.encode())
    assert f"text-characters: {len(text)}\r\n" in records["metadata"].record


class Reader(HTMLParser):
    """Visible text by the library's tokenizer."""

    BLOCKS = {"p", "div", "br", "li", "h1", "td"}
    HIDDEN = {"script", "style", "template"}

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.out, self.inside = [], []

    def handle_starttag(self, tag, attrs):
        if tag in self.HIDDEN:
            self.inside.append(tag)
        elif tag in self.BLOCKS:
            self.out.append("\n")

    def handle_startendtag(self, tag, attrs):
        if tag in self.BLOCKS:
            self.out.append("\n")

    def handle_endtag(self, tag):
        if tag in self.HIDDEN:
            self.inside = self.inside[:-1]
            self.out.append(" ")
        elif tag in self.BLOCKS:
            self.out.append("\n")

    def handle_comment(self, data):
        self.out.append(" ")

    def handle_data(self, data):
        if not self.inside:
            self.out.append(data)


def read_by_library(page):
    reader = Reader()
    reader.feed(page)
    reader.close()
    lines = (" ".join(x.split()) for x in "".join(reader.out).split("\n"))
    return "\n".join(x for x in lines if x)


PIECES = [
    "<p>", "</p>", "<br/>", "<br>", "<div class=a>", '<div title="x > y">', "<p title='it is > b'>", "<p title=don't>",
    '<a href=a"b>', "<b data-x = 'q > \"r'>", "</b>", "<i disabled>", "</a>", "<li a=1 b='2' c>", "<h1 id=\n'z>'\n>",
    "<!-- a > b -->", "<script>if (a < b) { x = '<p>' }</script>", "<style>p > a { }</style>", "<td=x>",
    " text ", "Hello it's a > b", " &amp; &lt;p&gt; ", "1 < 2 ", "caf\u00e9 ", "&nbsp;x", "a=b 'c' \"d\" ", "\n",
]


def test_visible_text_agrees_with_the_library():
    rng = random.Random(11)
    for _ in range(4_000):
        page = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 12)))
        assert warc_derivatives.plain_text(page) == read_by_library(page), page


def test_quotes_open_values_after_an_equals_sign_only():
    assert warc_derivatives.plain_text("<p title=don't>Hello it's a > b</p>") == "Hello it's a > b"
    assert warc_derivatives.plain_text("<p a='x>y' b=\"z>\">in</p><!DOCTYPE x \"y\">out") == "in\nout"
    assert warc_derivatives.plain_text("<p a=\"never closed>text</p>") == "text"
    assert warc_derivatives.title_of("<title data-a='>'>T</title>") == "T"


def test_responses_of_files(spark, run_dir):
    rows = [(1, "http://a/x", PAGE), (2, "http://b", "plain \u00e9"), (3, None, None)]
    sources = warc_derivatives.responses(pages(spark, rows))
    warc_derivatives.write_warc(warc_derivatives.response_records(sources), run_dir)
    back = warc_derivatives.responses_of(warc_derivatives.read_warc(spark, run_dir))
    told = ("record_id", "target_uri", "date", "http_headers", "payload", "payload_digest")
    assert sorted(map(tuple, back.select(*told).collect())) == sorted(map(tuple, sources.select(*told).collect()))
    derived = warc_derivatives.derivatives(back).drop("page_id")
    wanted = warc_derivatives.derivatives(sources).drop("page_id")
    assert sorted(map(tuple, derived.collect()), key=str) == sorted(map(tuple, wanted.collect()), key=str)


def test_bodies_in_chunks_gzip_and_other_charsets():
    page = "<p>\u00e9t\u00e9</p>"
    packed = gzip.compress(page.encode("latin-1"))
    sent = b"".join(b"%x\r\n%s\r\n" % (len(x), x) for x in (packed[:7], packed[7:])) + b"0\r\n\r\n"
    head = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=ISO-8859-1\r\n"
        b"Transfer-Encoding: chunked\r\nContent-Encoding: gzip\r\n\r\n"
    )
    headers, found, body = warc_derivatives.payload_of(head + sent)
    assert found == page and body == sent and headers.startswith("HTTP/1.1 200 OK\r\n")
    assert warc_derivatives.payload_of(b"")[1] == ""
    assert warc_derivatives.payload_of(b"H\r\nContent-Type: a; charset=no\r\n\r\nx\xff")[1] == "x\ufffd"
    assert warc_derivatives.payload_of(b"H\r\nContent-Encoding: gzip\r\n\r\nxyz")[1] == ""


def test_no_pages(spark):
    assert warc_derivatives.derivatives(warc_derivatives.responses(pages(spark, []))).count() == 0


def clean(seed, n=120):
    return prose(seed, n, [f"{a}{b}" for a in ("lo", "mi", "ta", "ne") for b in ("ra", "so", "ki", "du", "ve", "no")] + [f"w{i}" for i in range(600)])


@pytest.fixture
def corpus(spark, run_dir):
    passage, secret = clean(900, 70), clean(901, 40)
    rows = [(i, clean(i)) for i in range(20)]
    rows += [(20, "too short"), (21, "a b c d e f g h " * 9), (22, None), (23, rows[3][1]), (24, rows[4][1] + " end")]
    rows += [(25, clean(25) + "\n" + passage), (26, clean(26) + "\n" + passage + "\n" + clean(27))]
    rows += [(28, clean(28) + " " + secret + " " + clean(29)), (None, clean(30)), (31, clean(31)), (31, clean(31))]
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs.write.parquet(f"{run_dir}/documents.parquet")
    bench = spark.createDataFrame([(1, secret), (2, None)], "item_id long, text string")
    bench.write.parquet(f"{run_dir}/benchmark.parquet")
    return run_dir, dict((r for r in rows if r[0] is not None)), passage, secret


def test_stages_take_effect(spark, corpus):
    sf_dir, texts, passage, secret = corpus
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        out.write.parquet(f"{sf_dir}/{name}")
        docs = spark.read.parquet(f"{sf_dir}/{name}")
        kept[name] = docs.collect()
    ids = {name: sorted((r.doc_id for r in rows if r.doc_id is not None)) for name, rows in kept.items()}
    everything = [*range(20), 23, 24, 25, 26, 28, 31, 31]
    assert ids["quality_rules"] == everything
    once = [*range(20), 25, 26, 28, 31]
    assert ids["near_duplicates"] == once and len(kept["near_duplicates"]) == len(once) + 1
    cut = {r.doc_id: r for r in kept["substring_dedup"]}
    assert cut[25].text == texts[25] and cut[26].text == clean(26) + "\n\n" + clean(27)
    assert cut[26].n_chars == len(cut[26].text) and ids["substring_dedup"] == once
    last = {r.doc_id: r for r in kept["decontaminate"]}
    assert last[28].text == clean(28) + "  " + clean(29) and last[28].n_chars == len(last[28].text)
    assert all(last[i].text == texts[i] for i in range(20))
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir).collect()
    assert sorted({r.doc_id for r in packed if r.doc_id is not None}) == once
    assert sum(r.length for r in packed) <= 2048 * len({r.sequence_id for r in packed})


def test_one_of_near_copies_under_one_id_stays(spark, run_dir):
    same, unlike, more = clean(50), clean(51), clean(52)
    rows = [(7, same + " first"), (7, same + " second"), (9, same + " third"), (7, unlike), (8, unlike + " x")]
    rows += [(None, more + " a"), (None, more + " b"), (5, ""), (5, None), (6, ""), (None, "")]
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    out = [(r.doc_id, r.text) for r in corpus_pipeline.near_duplicates(spark, docs, run_dir).collect()]
    assert len([1 for i, t in out if (t or "").startswith(same)]) == 1
    assert {i for i, t in out if (t or "").startswith(same)} == {7}
    assert [(i, t) for i, t in out if (t or "").startswith(unlike)] == [(7, unlike)]
    assert len([1 for i, t in out if (t or "").startswith(more)]) == 1
    assert sorted([i for i, t in out if t == ""], key=str) == [5, 6, None] and (5, None) in out


def test_stages_keep_columns_with_any_name(spark, run_dir):
    names = ["cut_text", "cut_id", "cut_fp", "kept_id", "kept_fp", "_cut", "_bench_spans", "_row_fp", "bench_cut", "CUT_x"]
    passage, secret = clean(900, 70), clean(901, 40)
    rows = [(1, clean(1) + "\n" + passage), (2, clean(2) + "\n" + passage), (3, clean(1) + "\n" + passage)]
    rows += [(4, clean(4) + " " + secret), (5, clean(5))]
    docs = frame(spark, rows).select("doc_id", "text", "lang", "source", "n_chars")
    docs = docs.select("*", *(F.concat(F.lit(f"{n}/"), "doc_id").alias(n) for n in names))
    bench = spark.createDataFrame([("one", secret)], "item_id string, text string")
    bench.write.parquet(f"{run_dir}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, run_dir)
        assert out.columns == docs.columns
        out.write.parquet(f"{run_dir}/{name}")
        docs = spark.read.parquet(f"{run_dir}/{name}")
    found = {r.doc_id: r for r in docs.collect()}
    assert sorted(found) == [1, 2, 4, 5]
    assert all(r[n] == f"{n}/{i}" for i, r in found.items() for n in names)
    assert found[2].text == clean(2) + "\n" and found[4].text == clean(4) + " "


def test_run_gives_the_last_stage(spark, corpus):
    found = corpus_pipeline.run(spark, corpus[0])
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert found.select("doc_id").distinct().count() == 25


def test_empty_corpus(spark, run_dir):
    frame(spark, []).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{run_dir}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{run_dir}/benchmark.parquet")
    assert corpus_pipeline.run(spark, run_dir).count() == 0
