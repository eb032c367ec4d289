"""Extraction of small hand-made pages."""

import json
import re
from html.parser import HTMLParser

from conftest import AS_OF
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from snapwatch.operators import extract_html, extract_json, json_keys, links
from snapwatch.operators.html_fields import Board, Field, Page, Reader, Step, raw_records, raw_records_of, read_page
from snapwatch.plans import board_pages

# ---- JSON ----


def result(link="/job/1/ab/", **parts):
    base = {
        "JobInfo": {"Link": link, "Date": "05/10/2016"},
        "JobContent": {"Name": "n", "Description": "d", "Requirement": "r", "Categories": [], "Addresses": []},
        "Company": {"CompanyDisplayName": "c", "ToUrl": "co/1"},
    }
    base.update(parts)
    return base


def api(spark, *bodies):
    texts = [b if isinstance(b, str) or b is None else json.dumps(b, ensure_ascii=False) for b in bodies]
    return spark.createDataFrame(list(enumerate(texts)), "page long, body string")


def test_json_fields(spark):
    content = {"Name": "שם", "Description": "d", "Categories": [{"NameInHebrew": "x"}, {"NameInHebrew": ""}, {}],
               "Addresses": [{"City": "c1"}, {"City": ""}, {}]}
    row = extract_json.extract(api(spark, {"ResultList": [result(JobContent=content)]}), AS_OF).first()
    assert (row.Job_id, row.unique_id, row.Job_categories, row.Country_Areas) == ("1-ab", "drushim_1-ab", "x", "c1  ")
    assert (row.Job_Description, row.Job_Post_Date, row.Job_title) == ("d\n", "10/05/2016", "שם")
    assert row.Job_URL == "https://www.drushim.co.il/job/1/ab/" and row.Company_jobs == "https://www.drushim.co.il/co/1"


def test_json_missing_parts(spark):
    row = extract_json.extract(api(spark, {"ResultList": [{"JobInfo": {"Link": "/x/"}}]}), AS_OF).first()
    assert (row.Job_id, row.Company, row.Company_jobs, row.Job_title) == ("x", None, None, None)
    assert (row.Job_Description, row.Job_Post_Date, row.Country_Areas, row.Job_categories) == ("\n", "15/01/2024", "", "")


def test_json_first_seen_id_wins_in_page_order(spark):
    pages = api(spark, {"ResultList": [result("/a/1/"), result("/a/1/"), result("/")]},
                {"ResultList": [result("/a/1"), result("/a/2", Company={"CompanyDisplayName": "late"})]})
    got = sorted((r._page, r._pos, r.Job_id) for r in extract_json.extract(pages, AS_OF).collect())
    assert got == [(0, 0, "a-1"), (1, 1, "a-2")]
    assert extract_json.extract(pages, AS_OF, first_seen=False).count() == 4


def test_json_quarantine(spark):
    good = {"ResultList": [result()], "NextPageNumber": -1, "TotalPagesNumber": 7}
    pages = api(spark, good, '{"ResultList": [', {"Message": "x"}, {"ResultList": None}, {"ResultList": []}, "", None,
                {"ResultList": [result(), {"JobInfo": {}}]}, "[1]")
    got = {r.page: r.reason for r in extract_json.quarantine(pages).collect()}
    assert got == {1: "broken", 2: "no_results", 5: "broken", 6: "broken", 7: "no_link", 8: "broken"}
    totals = {r.page: (r.next_page, r.total_pages, r.n) for r in extract_json.page_totals(pages).collect()}
    assert totals == {0: (-1, 7, 1), 3: (4, 0, 0), 4: (5, 0, 0), 7: (8, 0, 2)}


# ---- Page reader ----


def texts(html, *steps, read="string", only_first=False):
    page = Page(html)
    return page.read([0], Field(tuple(steps), read, only_first))


def test_reader_structure():
    assert texts("<ul><li>a<li>b</ul>", Step("li")) == ["a", "b"]
    assert texts("<p>one<div>two</div>", Step("p")) == ["one"]
    assert texts("<p>one<b>x<p>two", Step("p")) == ["onextwo", "two"]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>", Step("tr")) == ["12", "3"]
    assert texts("<div>a<br>b<img src=x>c</div></div>d", Step("div")) == ["abc"]
    assert texts("<a>x</b>y</a>", Step("a")) == ["xy"]
    assert texts("<div/>a<div>b", Step("div")) == ["", "b"]


def test_reader_texts_and_comments():
    assert texts("<div>a<b>c</b>d<!-- <div>no</div> -->e</div>", Step("div"), read="text") == ["a", "d", "e"]
    assert texts("<div>x &amp; y &#1488;&nbsp;</div>", Step("div")) == ["x & y א\xa0"]
    assert texts("<script>if (a<b) '</p><p>'</script><p>t</p>", Step("p")) == ["t"]
    assert texts("<SCRIPT>'<p>'</script><p>t</p>", Step("p")) == ["t"]
    assert texts("<p>1 < 2 and <3</p>", Step("p")) == ["1 < 2 and <3"]
    assert texts("<!DOCTYPE html><?x?><p>t", Step("p")) == ["t"]
    assert texts("<style>p{}</style><p>t</p><!-- open", Step("p")) == ["t"]


def test_reader_attributes():
    html = """<a HREF='/x?a=1&amp;b=2' class=plain data-x>t</a><a href="a>b" href="no">u</a><a>none</a>"""
    assert texts(html, Step("a"), read="@href") == ["/x?a=1&b=2", "a>b"]
    assert texts(html, Step("a", "class", equals="plain")) == ["t"]
    assert texts(html, Step("a", "href", holds="a=1&b")) == ["t"]
    assert texts(html, Step("a", "data-x", holds="")) == ["t"]
    assert texts("<a href='x", Step("a")) == []
    assert texts("<div id=o><p>1</p></div>", Step("p"), read="..@id") == ["o"]


def test_reader_steps():
    html = "<div class='a b'><p>1</p><div class='a b'><p>2</p></div></div><div class='a b '><p>3</p></div>"
    assert texts(html, Step("div", "class", equals="a b"), Step("p", child=True)) == ["1", "2"]
    assert texts(html, Step("div", "class", holds="a b"), Step("p")) == ["1", "2", "3"]
    assert texts(html, Step("div"), Step(child=True)) == ["1", "2", "2", "3"]


def test_reader_needs_linear_time_on_odd_pages():
    assert Page("<div>" * 20_000).tags.count("div") == 20_000
    for piece in ("<a b='", "<", "a<", "<!--", "</a", "<a =", "<a b=\"'"):
        assert len(Page(piece * 50_000).tags) <= 2
    assert texts("<p>" + "< " * 5_000, Step("p")) == ["< " * 5_000]


def test_reader_closing_slash():
    assert texts("<a href=/x/>t</a>", Step("a")) == ["t"]
    assert texts("<a href='/x'/>t", Step("a")) == [""]
    assert texts("<i a/>t", Step("i")) == [""]
    assert texts("""<a title="5" tall">t</a>""", Step("a")) == ["t"]


class _Plain(HTMLParser):
    """Start tags and texts as the standard library sees them."""

    def __init__(self):
        super().__init__()
        self.tags, self.seen, self.title, self.heading = [], [], "", 0

    def handle_starttag(self, tag, attrs):
        self.tags.append((tag, {k: v or "" for k, v in reversed(attrs)}))
        self.heading += tag == "h1"

    def handle_endtag(self, tag):
        self.heading += 100 * (tag == "h1")

    def handle_data(self, data):
        self.seen.append(data)
        if self.heading == 1:
            self.title += data


def test_reader_agrees_with_the_standard_library_on_saved_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()
    assert len(pages) >= 50
    for saved in pages:
        plain, own = _Plain(), Page(saved.html)
        plain.feed(saved.html)
        plain.close()
        assert [(t, own.attrs(n)) for n, t in enumerate(own.tags) if n] == plain.tags
        assert "".join(own.texts) == "".join(plain.seen)
        closed = "</h1>" in saved.html
        heading = own.read([0], Field((Step("article"), Step("h1"))))
        assert not closed or heading == [plain.title]


def test_end_tags_of_nothing_open_need_linear_time():
    import time

    took = []
    for n in (10_000, 40_000):
        html = "<div>" * n + "</i></b></p>" * n
        read_page("<i><b><p>" + html, Board(records=((Step("li"),),), fields={}))
        started = time.process_time()
        Page("<i></i><b></b><p></p>" + html)
        Page("<a><p>" + "<b>" * n + "<a>x" * n)
        took.append(time.process_time() - started)
    assert took[1] < 12 * took[0] + 0.2


def test_names_in_upper_case_and_links_without_end():
    html = "<DIV ID='job-box77' CLASS=x><A HREF=/one>1 <b>bold<a href='/two'>2</A><div>3</div></DIV><p>out"
    nodes = Board(
        records=((Step("div", "class", equals="x"),),),
        fields={"id": Field((Step("div", "id", or_self=True),), "@id"), "texts": Field((Step("a", "href"),), only_first=False),
                "links": Field((Step("a", "href"),), "@href", only_first=False)},
    )
    assert read_page(html, nodes) == [{"id": ["job-box77"], "texts": ["1 bold", "2"], "links": ["/one", "/two"]}]
    cells = "<a href=1>x<table><tr><td><a href=2>y</a></td></tr></table></a>"
    assert len(Page(cells).by_tag["a"]) == 2


# ---- Boards. Classes, ids, attributes and links in the samples are the boards' own. ----


def page(spark, html, url="https://www.alljobs.co.il/SearchResultsGuest.aspx?page=1"):
    return spark.createDataFrame([(1, url, html)], "page_id long, url string, html string")


def test_alljobs_without_details(spark):
    html = "<div class='organic-board'><i id='x'></i></div><div class='open-board'><i id='b7c9'><h2>no</h2></i></div><div class='open-board x'></div>"
    rows = extract_html.extract(page(spark, html), "AllJobs", AS_OF).orderBy("pos").collect()
    assert [(r.Job_id, r.unique_id, r.Job_URL) for r in rows] == [
        ("7", "alljobs_7", "http://www.alljobs.co.il/Search/UploadSingle.aspx?JobID=7"), ("", "alljobs_", "")]
    # No company link: the page's own link holds the marker, so the job's link takes its place.
    assert rows[0].Company_jobs == rows[0].Job_URL and rows[0].Company == "חברה חסויה"
    assert (rows[0].Job_Post_Date, rows[0].Job_title, rows[0].Job_Description, rows[0].Country_Areas) == ("", None, "", None)


def test_alljobs_description_belongs_to_its_own_id(spark):
    html = """<div class="open-board"><div id="job5"><div id="job-content-top-acord5"><p>a</p> <p> </p><p>b  c</p></div>
              <div id="job-content-top-acord6"><p>other</p></div></div></div>"""
    row = extract_html.extract(page(spark, html), "AllJobs", AS_OF).first()
    assert row.Job_Description == "a\nb c\n"


def test_jobmaster_class_is_exact_and_parts_start_at_the_third(spark):
    inner = """<div class="JobItemRight Transition"><a class="CardHeader">t</a><div><a class="font14 CompanyNameLink"> c </a></div>
               <p>x  y</p><p></p><div class="paddingTop10px"><span class="Gray">חדש</span></div></div>
               <div class="JobItemBottom"><span class="bottomItems twoBTNS bottomItemsCompany" onclick="window.open('co/3',1)"></span></div>"""
    html = f"<article class='CardStyle JobItem font14 ' id='m31'>{inner}</article><article class='CardStyle JobItem font14' id='m32'></article>"
    rows = extract_html.extract(page(spark, html, "https://www.jobmaster.co.il/jobs/?l=1"), "JobMaster", AS_OF).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.Job_id, row.Company, row.Job_Description, row.Job_Post_Date) == ("31", "c", "x y\n\nחדש\n", "15/01/2024")
    assert row.Company_jobs == "https://www.jobmaster.co.il/jobs/co/3"


def test_jobnet_rows_without_link(spark):
    html = """<table id="ContentPlaceHolder1_ucSearhRes_rptResults"><tr><td><h2 itemprop="title">t</h2></td></tr>
              <tr><td><a href="/jobs?p=1&positionid=4%20x">l</a><p itemprop="datePosted"> raw </p></td></tr></table>"""
    rows = extract_html.extract(page(spark, html, "u"), "JobNet", AS_OF).orderBy("pos").collect()
    assert [(r.Job_id, r.unique_id, r.Job_URL, r.Company_jobs) for r in rows] == [
        ("", "jobnet_", "", ""), ("4 x", "jobnet_4 x", "http://www.jobnet.co.il/jobs?p=1&positionid=4%20x", "")]
    assert rows[1].Job_Post_Date == " raw " and rows[0].Company is None and rows[0].Job_Description == ""


def test_drushim_html_ids_count_once(spark):
    box = """<div class="job-item-main pb-3 job-hdr"><div class="x nowrap align-self-center pc-view open-job text-center"><a href="/job/1/ab/"></a></div>
             <div class="layout job-details-sub">area | x</div></div>"""
    html = box + box + '<div class="job-item-main pb-3 job-hdr"></div>'
    rows = extract_html.extract(page(spark, html, "u"), "Drushim", AS_OF).collect()
    assert [(r.pos, r.Job_id, r.Job_URL, r.Country_Areas, r.Job_categories, r.Job_Post_Date) for r in rows] == [
        (0, "1-ab", "https://www.drushim.co.il/job/1/ab", "area", "", "")]


def test_own_board(spark):
    nodes = Board(records=((Step("li"),),), fields={"name": Field((Step("b"),)), "all": Field((Step("i"),), only_first=False)})
    raw = raw_records(page(spark, "<ul><li><b>x</b><i>1</i><i>2</i><li>none</ul>"), nodes)
    assert [(r.pos, r["name"], r["all"]) for r in raw.orderBy("pos").collect()] == [(0, "x", ["1", "2"]), (1, None, [])]
    assert read_page(None, nodes) == []
    blank = {c: F.lit("") for c in ("Company_jobs", "Job_title", "Job_Description", "Job_Post_Date", "Job_URL", "Country_Areas",
                                    "Job_categories", "AllJobs_Job_class")}
    extract_html.register_board(
        "Mine", "mine", nodes, lambda as_of: {"Company": F.col("name"), "Job_id": F.coalesce("name", F.lit("")), **blank}, True)
    try:
        rows = extract_html.extract(page(spark, "<ul><li><b>x</b><li><b>x</b><li>none</ul>"), "Mine", AS_OF).collect()
        assert [(r.Site, r.unique_id) for r in rows] == [("Mine", "mine_x")]
    finally:
        del extract_html.BOARDS["Mine"]


# ---- Links ----


def test_outlinks(spark):
    html = """<a href="/jobs/?l=1&amp;x=2">a</a><!-- <a href="/no">n</a> --><script>'<a href="/no">'</script>
              <A class=x HREF='rel'>b</A><a name=q>c</a><abbr href="/no">"""
    rows = links.outlinks(page(spark, html, "https://a.example/d/p")).orderBy("position").collect()
    assert [(r.href, r.target) for r in rows] == [("/jobs/?l=1&x=2", "https://a.example/jobs/?l=1&x=2"), ("rel", "https://a.example/d/rel")]
    assert links.outlinks(page(spark, html), links.SUB_REGION_LINK).count() == 1


def test_page_numbers(spark):
    pager = '<a class="btnPaging Selected">{}</a><a class="btnPaging "> 4 </a><a class="btnPaging ">next</a>'
    rows = [(1, "/jobs?p=3", pager.format(3)), (2, "/jobs?p=2", pager.format(3)), (3, "/jobs?p=4", pager.format(4)), (4, "/jobs?p=1", "none")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: (r.selected, r.listed, r.next_page) for r in links.page_numbers(df).collect()}
    assert got == {1: (3, [4], 4), 2: (3, [4], 3), 3: (4, [4], None), 4: (None, [], None)}


def test_links_in_all_their_shapes(spark):
    html = """<a href=/plain>1</a><a onclick="a>b" href="/gt">2</a><a href="/ok">3</a><a href='/x&#x27;y&eacute;'>4</a><a href=>5</a><a HREF>6</a>"""
    rows = links.outlinks(page(spark, html, "https://a.example/p")).orderBy("position").collect()
    assert [r.href for r in rows] == ["/plain", "/gt", "/ok", "/x'yé", "", ""]


def test_pager_in_all_its_shapes(spark):
    html = """<!-- <a class="btnPaging ">9</a> --><a class='btnPaging Selected'><b>3</b></a><a title=">" class="btnPaging ">4</a>"""
    row = links.page_numbers(page(spark, html, "/jobs?p=3")).first()
    assert (row.selected, row.listed, row.next_page) == (3, [4], 4)


def test_next_page_links_and_location_ids(spark):
    html = "<a class=paginationPrev href='?currPage=2&amp;l=1'>x</a><a href=/jobs/?l=5>a</a><a href='/jobs/?l=6'>b</a>"
    pages = page(spark, html, "https://www.jobmaster.co.il/jobs/?l=1").withColumn("region", F.lit(4))
    assert links.next_page_links(pages, "JobMaster").first().target == "https://www.jobmaster.co.il/jobs/?currPage=2&l=1"
    assert links.next_page_links(page(spark, "<p>last"), "AllJobs").first().target is None
    assert [r.location_id for r in links.sub_region_links(pages).orderBy("target").collect()] == ["4_0", "4_1"]
    regions = "<a href='/jobs/searchfilterHome.asp?type=ezor&l=2'>x</a><a href='/no'></a><a href='/jobs/searchfilterHome.asp?type=ezor&amp;l=3'>y</a>"
    assert [r.region for r in links.region_links(page(spark, regions)).orderBy("region").collect()] == [0, 1]


def test_code_travels_with_the_tasks(tmp_path):
    """Executors without the package can still read pages."""
    import subprocess
    import sys

    from pyspark import cloudpickle

    import __spark_entry__  # noqa: F401

    nodes = Board(records=((Step("li"),),), fields={"name": Field((Step("b"),))})
    (tmp_path / "task").write_bytes(cloudpickle.dumps((read_page, nodes)))
    code = "import pickle; read, nodes = pickle.load(open('task', 'rb')); print(read('<li><b>x</b>', nodes))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=60)
    assert done.stdout.strip() == "[{'name': ['x']}]", done.stderr


def test_pages_stand_in_every_partition(spark):
    spread = board_pages.spread_events(spark, "/root/testdata/sf0.001")
    held = spread.groupBy(F.spark_partition_id().alias("part")).count().count()
    assert held == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_unknown_and_retyped_keys(spark):
    """New keys at every depth and values of another kind are counted; known ones, null and what is no JSON are not."""
    from snapwatch.operators import json_keys

    rows = [
        (1, '{"ResultList":[{"JobInfo":{"Link":"/a","Date":3,"Salary":9.5},"JobContent":{"Categories":"none"},"Company":null},{"JobInfo":[1]}],"Promo":{"x":{"y":1}},"NextPageNumber":{"z":1}}'),
        (2, None),
        (3, "{broken"),
        (4, "[1]"),
        (5, '{"Promo":[],"Promo2":null,"a.b":true,"TotalPagesNumber":7}'),
        (6, "null"),
        (7, '"text"'),
        (8, ""),
        (9, '{"ResultList":[{"JobInfo":{"Salary":1.25},"JobContent":{"Categories":[{"NameInHebrew":{}}]}}],"Promo":{}}'),
    ]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "page long, body string, path string, n int")
    got = {(r.path, r.type): (r.n, r.first_page) for r in json_keys.unknown_keys(docs).collect()}
    assert got == {
        ("$", "ARRAY"): (1, 4),
        ("$[]", "BIGINT"): (1, 4),
        ("$", "STRING"): (1, 7),
        ("$.NextPageNumber", "OBJECT"): (1, 1),
        ("$.Promo", "OBJECT"): (2, 1),
        ("$.Promo", "ARRAY"): (1, 5),
        ("$.Promo2", "VOID"): (1, 5),
        ("$.a.b", "BOOLEAN"): (1, 5),
        ("$.ResultList[].JobContent.Categories", "STRING"): (1, 1),
        ("$.ResultList[].JobContent.Categories[].NameInHebrew", "OBJECT"): (1, 9),
        ("$.ResultList[].JobInfo", "ARRAY"): (1, 1),
        ("$.ResultList[].JobInfo[]", "BIGINT"): (1, 1),
        ("$.ResultList[].JobInfo.Salary", "DECIMAL"): (2, 1),
    }
    assert json_keys.unknown_keys(docs.limit(0)).collect() == []


def test_values_in_which_nothing_is_unknown_are_not_opened():
    """A type as a whole tells it; kinds that differ between elements or a key that must be quoted do not."""
    shape = re.compile("|".join(json_keys.shapes_of(StructType.fromDDL(extract_json.API_PAGE))))
    info = "OBJECT<Date: STRING, Link: {}>"
    for kind in ("STRING", "VOID", "BIGINT", "DECIMAL(5,1)", "TIMESTAMP_NTZ"):
        assert shape.fullmatch("$.ResultList[].JobInfo " + info.format(kind))
        assert shape.fullmatch(f"$ OBJECT<NextPageNumber: VOID, ResultList: ARRAY<OBJECT<Company: VOID, JobInfo: {info.format(kind)}>>>")
    for kind in ("VARIANT", "OBJECT<>", "OBJECT<Link: STRING>", "ARRAY<VOID>", "ARRAY<STRING>", "STRING, Salary: DECIMAL(5,1)", "STRING, `a, Date`: STRING"):
        assert not shape.fullmatch("$.ResultList[].JobInfo " + info.format(kind))
        assert not shape.fullmatch(f"$ OBJECT<ResultList: ARRAY<OBJECT<JobInfo: {info.format(kind)}>>>")
    for text in ("$ OBJECT<>", "$ VOID", "$.ResultList ARRAY<VOID>"):
        assert shape.fullmatch(text)
    for text in ("$ ARRAY<VOID>", "$.Promo VOID", "$.ResultList OBJECT<>", "$.ResultList ARRAY<VARIANT>", "$.NextPageNumber OBJECT<>"):
        assert not shape.fullmatch(text)


def test_types_of_a_page_are_read_once(spark):
    """No condition on rows reads them anew in each of its terms."""
    docs = spark.sql("SELECT id AS page, concat('[', id, ']') AS body FROM range(3)").repartition(3, "page")
    plan = json_keys.unknown_keys(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1 and "schemaOfVariant" in plan
    assert not [line for line in plan.split("\n") if line.lstrip("+- :").startswith("Filter")]


def test_steps_fit_however_the_attribute_is_written():
    shapes = (' class="{}"', " class='{}'", ' CLASS="{}"', ' id="x" class="{}"', ' class = "{}"', ' class="{}" class="no"', ' class="a&amp;b {}"', ' class="{}')
    for shape in shapes:
        for value, sought in (("T14", "T14"), ("T14 big", "T14"), ("T1", "T14"), ("", "T14"), ("T14 ", "T14")):
            page = Page(f"<div{shape.format(value)}>x</div><p>y</p>")
            for step in (Step("div", "class", equals=sought), Step("div", "class", holds=sought), Step("div", "class", holds="")):
                assert page.matching(step) == [n for n in page.by_tag.get("div", []) if step.fits(page.attrs(n))]


# ---- Work of a page stands in the step that the pages are spread for ----


def _before_the_spread(found):
    """The part of the optimized plan that runs in front of the step that spreads the pages."""
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 1
    return plan[plan.index("RepartitionByExpression") :]


def test_pages_are_made_and_read_after_they_are_spread(spark, tmp_path):
    folder = str(tmp_path)
    events = spark.sql("SELECT id AS event_id, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS ts, id AS user_id, 'k' AS event_type, 'p' AS props FROM range(9)")
    events.write.parquet(f"{folder}/events.parquet")
    for site, pages in (("AllJobs", board_pages.alljobs_pages), ("JobMaster", board_pages.jobmaster_pages), ("JobNet", board_pages.jobnet_pages)):
        assert "concat" not in _before_the_spread(extract_html.extract(pages(spark, folder), site, AS_OF))


def test_pages_of_other_sites_and_without_a_marker_give_no_record(spark):
    box, ref = "<div class='open-board'><i id=7>x</i></div>", "<div class='open&#45;board'><i id=8>x</i></div>"
    rows = [("AllJobs", 1, "u", box), ("AllJobs", 2, "u", ref), ("AllJobs", 3, "u", "<p>x"), ("AllJobs", 4, "u", None), ("Other", 5, "u", box),
            (None, 6, "u", box), ("Own", 7, "u", "<li>1<li>2"), ("Own", 8, "u", None)]
    pages = spark.createDataFrame(rows, "site string, page_id long, url string, html string")
    own = Board(records=((Step("li"),), ()), fields={"own": Field(())})
    raw = raw_records_of(pages, {"AllJobs": extract_html.ALLJOBS, "Own": own})
    got = sorted((r.site, r.page_id, r.pos, r.id, r.own) for r in raw.collect())
    assert got == [("AllJobs", 1, 0, "7", None), ("AllJobs", 2, 0, "8", None), ("Own", 7, 0, None, "1"), ("Own", 7, 1, None, "2"),
                   ("Own", 7, 2, None, "12"), ("Own", 8, 0, None, "")]


def test_a_tag_is_worked_out_once_and_few_are_kept():
    nodes = Board(records=((Step("div", "class", equals="x"),),), fields={"id": Field((Step("i", "id"),), "@id"), "own": Field((), "text", False)})
    reader, html = Reader(nodes), "<div class=x>a<i id={}>b</i>c<!-- {} --><script>'{}'</script>d</div>"
    for n in range(5_000):
        assert reader.read(html.format(n, n, n)) == [[[str(n)], ["a", "c", "d"]]]
        assert len(reader._tags.known) <= 4096
    kept = reader._tags.known["<div class=x>"]
    reader.read(html.format(1, 1, 1))
    assert reader._tags.known["<div class=x>"] is kept
