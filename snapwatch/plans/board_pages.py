"""Board-shaped pages rendered from the events table, one page with two postings per event.

They feed the extraction queries, whose twins read the same columns straight from the events.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from snapwatch.plans.views import table


def render(template: str, **columns: Column) -> Column:
    """Fill the ``{name}`` places of a template with columns; NULL gives the empty string."""
    pieces: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            pieces.append(F.lit(literal))
        if name:
            pieces.append(F.coalesce(columns[name].cast("string"), F.lit("")))
    return F.concat(*pieces)


def spread_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events spread over tasks while rows are still narrow: parsing the pages is the costly part.

    The number is given, as adaptive execution would merge partitions of so few bytes into one.
    """
    return table(spark, sf_dir, "events").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "event_id")


def _event_columns() -> dict[str, Column]:
    user = F.col("user_id")
    return {
        "event": F.col("event_id"),
        "user": user,
        "kind": F.col("event_type"),
        "props": F.col("props"),
        "area": F.concat(F.lit("area "), user % 9),
        "day": F.date_format("ts", "dd/MM/yyyy"),
        "ago": F.concat(F.lit("לפני "), user, F.lit(" ימים")),
    }


def _two(template: str, columns: dict[str, Column], **per_posting) -> Column:
    """The template for posting 0 and 1; ``per_posting`` values are functions of the posting number."""
    parts = []
    for i in (0, 1):
        own = {name: value(i) for name, value in per_posting.items()}
        parts.append(render(template, job=F.col("event_id") * 2 + i, **columns, **own))
    return F.concat(*parts)


# ---- JSON pages ----


def api_results(link: Column) -> Column:
    """Two results; optional keys are missing for some users."""
    user = F.col("user_id")
    date = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    results = []
    for i in (0, 1):
        results.append(
            F.struct(
                F.struct(
                    F.concat(link, F.lit("/"), F.col("event_type"), F.lit(f"{i}/")).alias("Link"),
                    (date if i == 0 else F.lit("")).alias("Date"),
                ).alias("JobInfo"),
                F.struct(
                    F.concat(F.lit("Job "), F.col("props")).alias("Name"),
                    F.col("props").alias("Description"),
                    F.when(user % 5 != 0, F.concat(F.lit("by "), user)).alias("Requirement"),
                    F.array(
                        F.struct(F.col("event_type").alias("NameInHebrew")),
                        F.struct(F.lit("").alias("NameInHebrew")),
                        F.struct(F.lit(None).cast("string").alias("NameInHebrew")),
                        F.struct(F.lit("משרה").alias("NameInHebrew")),
                    ).alias("Categories"),
                    F.array(
                        F.struct(F.concat(F.lit("city"), user % 7).alias("City")),
                        F.struct(F.lit("").alias("City")),
                        F.struct(F.lit(None).cast("string").alias("City")),
                    ).alias("Addresses"),
                ).alias("JobContent"),
                F.struct(
                    F.when(user % 11 != 0, F.concat(F.lit("c"), user, F.lit(" & co"))).alias("CompanyDisplayName"),
                    F.when(user % 13 != 0, F.concat(F.lit("company/"), user)).alias("ToUrl"),
                ).alias("Company"),
            )
        )
    return F.array(*results)


def api_pages(spark: SparkSession, sf_dir: str, by_user: bool = False) -> DataFrame:
    """(page, body): links name the event, or only the user, so that the same id comes on many pages."""
    link = F.concat(F.lit("/job/"), F.col("user_id" if by_user else "event_id"))
    body = F.to_json(
        F.struct(
            api_results(link).alias("ResultList"),
            F.when(F.col("event_id") % 3 != 0, F.col("event_id") + 1).alias("NextPageNumber"),
            F.lit(5000).alias("TotalPagesNumber"),
        )
    )
    return spread_events(spark, sf_dir).select(F.col("event_id").alias("page"), body.alias("body"))


def grown_api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages, some with keys that were not there before, or with a text where a list was."""

    def where(condition: Column, body: Column, old: str, new: str) -> Column:
        return F.when(condition, F.replace(body, F.lit(old), F.lit(new))).otherwise(body)

    page, body = F.col("page"), F.col("body")
    body = where(page % 5 == 1, body, '{"ResultList":', '{"Promo":{"x":1},"ResultList":')
    body = where(page % 3 == 0, body, '"JobInfo":{', '"JobInfo":{"Salary":9000.5,')
    body = where(page % 4 == 2, body, '"Categories":[', '"Categories":"none","Labels":[')
    return api_pages(spark, sf_dir).withColumn("body", body)


def damaged_api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages, some cut off, without a result list, with a null list, or with a result without a link."""
    shape = F.col("page") % 7
    body = (
        F.when(shape == 1, F.expr("left(body, length(body) - 1)"))
        .when(shape == 2, F.lit('{"Message": "busy", "TotalPagesNumber": 3}'))
        .when(shape == 3, F.lit('{"ResultList": null}'))
        .when(shape == 4, F.lit('{"ResultList": [{"JobInfo": {"Date": "2024-01-01"}}]}'))
        .when(shape == 5, F.lit(""))
        .otherwise(F.col("body"))
    )
    return api_pages(spark, sf_dir).select("page", body.alias("body"))


# ---- HTML pages. Classes, ids, attributes and link forms in the templates below are the boards' own. ----

_ALLJOBS_BOX = """<div class="{box}"><div id="job-box{job}" class="job-box">
<div class="job-content-top-date">{date}</div>
<div class="job-content-top-status-text"> full
  time </div>
<div class="job-content-top-title big"><div><a href="#"><{h}> Job {props} </{h}></a></div></div>
<div class="T14">{company}</div>
<div class="job-company-details"><span>{gad}</span></div>
<div class="job-content-top-location"><a>{area}</a><a>other</a></div>
<div id="job-content-top-acord{job}"><p>by  {user}</p><p> </p><div>{props} <b>for</b>
{kind}</div></div></div></div>"""


def alljobs_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns, user = _event_columns(), F.col("user_id")
    company = (
        F.when(user % 11 == 0, " ")
        .when(user % 11 == 1, render(" box  {user} <br> name ", **columns))
        .otherwise(render("<a href='#'> c{user} &amp; co </a>", **columns))
    )
    gad = F.when(user % 5 != 0, render('<a class="L_Blue gad" href="/Employer/?id={user}&amp;x=1">all</a>', **columns))
    boxes = _two(
        _ALLJOBS_BOX,
        columns,
        box=lambda i: F.lit(("open-board", "organic-board")[i]),
        h=lambda i: F.lit(("h2", "h3")[i]),
        date=lambda i: (columns["ago"], columns["day"])[i],
        company=lambda i: company,
        gad=lambda i: gad,
    )
    regions = F.when(
        F.col("event_id") % 3 == 0, F.lit('<div class="job-regions-box"><a>North</a> <span><a>South</a></span></div>')
    )
    following = F.when(
        F.col("event_id") % 4 != 0,
        render("<div class='jobs-paging-next'><a title='>' href=?page={next}&amp;type=>next</a></div>", next=F.col("event_id") + 1),
    )
    html = render(
        "<html><head><title>x</title></head><body>{regions}{boxes}{following}</body></html>", regions=regions, boxes=boxes, following=following
    )
    url = render("https://www.alljobs.co.il/SearchResultsGuest.aspx?page={event}&type=", **columns)
    return spread_events(spark, sf_dir).select(F.col("event_id").alias("page_id"), url.alias("url"), html.alias("html"))


_JOBMASTER_BOX = """<article class="CardStyle JobItem font14 " id="misra{job}">
<div class="JobItemRight Transition one"><a class="CardHeader View" href="#">Job <b>{props}</b></a>
<div>{company}</div><ul><li class="jobLocation"><span>{area}</span></li><li class="jobType"> {kind}  job </li></ul>
<p>by {user}</p><div class="paddingTop10px"><span class="Gray">{date}</span></div></div>
<div class="JobItemBottom x"><span class="bottomItems twoBTNS bottomItemsCompany"{onclick}>all</span></div></article>"""


def jobmaster_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns, user = _event_columns(), F.col("user_id")
    company = F.when(
        user % 11 == 0, render('<span class="font14 ByTitle"> hidden {kind} </span>', **columns)
    ).otherwise(render('<a class="font14 CompanyNameLink" href="#">c{user}  &amp; co</a>', **columns))
    onclick = F.when(
        user % 5 != 0, render(""" onclick="log('a');window.open('/co/{user}?x=1','_blank')\"""", **columns)
    )
    boxes = _two(
        _JOBMASTER_BOX,
        columns,
        date=lambda i: (columns["ago"], F.lit("חדש"))[i],
        company=lambda i: company,
        onclick=lambda i: onclick,
    )
    html = render("<html><body><article class='other' id='a1'>x</article>{boxes}</body></html>", boxes=boxes)
    url = render("https://www.jobmaster.co.il/jobs/?l={user}&currPage={event}", **columns)
    return spread_events(spark, sf_dir).select(F.col("event_id").alias("page_id"), url.alias("url"), html.alias("html"))


_JOBNET_ROW = """<tr><td><h2 itemprop="title"> Job  {props}</h2><a href="/about">x</a>{link}
<p itemprop="datePosted">{day}</p><p itemprop="hiringOrganization"> c{user} &amp; co {company_link}</p>
<div itemprop="description"> by {user} </div><div itemprop="skills"> {skills} </div>
<span itemprop="jobLocation">{area}</span><span itemprop="employmentType"> {kind} </span></td>"""


def jobnet_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are not closed, as saved tables often leave them."""
    columns, user = _event_columns(), F.col("user_id")
    rows = _two(
        _JOBNET_ROW,
        columns,
        link=lambda i: F.when(
            user % 6 != 0,
            render("<a href=\"/jobs?x=1&amp;positionid={job}\">go</a>", job=F.col("event_id") * 2 + i),
        ),
        company_link=lambda i: F.when(user % 5 != 0, render('<a href="/co/{user}">more</a>', **columns)),
        skills=lambda i: F.when(user % 4 != 0, columns["kind"]),
    )
    pager = render(
        """<!-- <a class="btnPaging ">7</a> --><a href=x class='btnPaging Selected'>{here}</a><a title=">" CLASS="btnPaging "> {next} </a>
        <script>"<a class='btnPaging '>8</a>"</script><a class="btnPaging ">...</a>""",
        here=F.col("event_id") % 50 + (user % 10 == 0).cast("int"),
        next=F.when(user % 3 != 0, F.col("event_id") % 50 + 1),
    )
    html = render(
        '<table id="ContentPlaceHolder1_ucSearhRes_rptResults">{rows}</table><div>{pager}</div>', rows=rows, pager=pager
    )
    url = render("https://www.jobnet.co.il/jobs?p={here}", here=F.col("event_id") % 50)
    return spread_events(spark, sf_dir).select(F.col("event_id").alias("page_id"), url.alias("url"), html.alias("html"))


_DRUSHIM_BOX = """<div class="job-item-main pb-3 job-hdr"><span class="job-url primary--text x"> Job {props}</span>
<div class="layout job-details-top mt-md-2"><div class="flex grow-none ml-3"><p> c{user} &amp; co <a href="/co/{user}">.</a></p></div></div>
<div class="layout job-intro vacancyMain">by {user}<br>{kind}</div>
<div class="layout job-details-sub"> {area} {rest}</div>
<div class="flex nowrap align-self-center pc-view open-job text-center">{link}</div></div>"""


def drushim_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns, user = _event_columns(), F.col("user_id")
    boxes = _two(
        _DRUSHIM_BOX,
        columns,
        rest=lambda i: F.when(F.lit(i == 0), render("| full | {kind} | {ago}", **columns)).otherwise("| full"),
        link=lambda i: F.when(
            user % 6 != 0, render('<a href="/job/{kind}/{job}/">go</a>', job=F.col("event_id") * 2 + i, **columns)
        ),
    )
    return spread_events(spark, sf_dir).select(
        F.col("event_id").alias("page_id"),
        F.lit("https://www.drushim.co.il/jobs/search/").alias("url"),
        render("<body>{boxes}</body>", boxes=boxes).alias("html"),
    )


# ---- Pages of links ----


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with six links each, written in all the ways that pages write them, and some that are none."""
    columns = _event_columns()
    html = render(
        """<a href=/plain/{event}>1</a><!-- <a href="/no">x</a> --><a onclick="if (a>b) go()" HREF='/gt/{user}'>2</a>
        <script>"<a href='/no'>"</script><A class=x data-href="/no" href = "/q?a={event}&amp;b=&#x27;{kind}&apos;">3</A>
        <a name="no">x</a><a href="rel/{user}">4<b>x<a href='//other.example/{kind}'>5</a><style>a <a href="/no"></style>
        <link href="/no"><a title='href="/no"' href="#top{event}">6""",
        **columns,
    )
    url = render("https://boards.example/list//{kind}/page", **columns)
    return spread_events(spark, sf_dir).select(F.col("event_id").alias("page_id"), url.alias("url"), html.alias("html"))


def region_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, url, html, region): a page per region with a link for every day on which the region has events."""
    region, day = (F.col("user_id") % 7).alias("region"), F.dayofmonth("ts").alias("day")
    days = table(spark, sf_dir, "events").select(region, day).groupBy("region").agg(F.sort_array(F.collect_set("day")).alias("days"))
    links = F.transform("days", lambda d: F.concat(F.lit("<li><a class=x href=/jobs/?l="), F.col("region"), F.lit("-"), d, F.lit(">x</a>")))
    url = F.concat(F.lit("https://www.jobmaster.co.il/jobs/searchfilterHome.asp?type=ezor&l="), F.col("region"))
    html = F.concat(F.lit("<a href='/jobs/'>all</a><ul>"), F.array_join(links, ""), F.lit("</ul>"))
    return days.select(F.col("region").cast("bigint").alias("page_id"), url.alias("url"), html.alias("html"), "region")


# ---- Pages of a board of one's own ----

_ARTICLE = """<article id="a{job}"><h1> Title <i>{props}</i></h1><p>by {user}<p>{props} &amp; more</article>"""


def article_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = _event_columns()
    html = render('<head><link rel="canonical" href="/{kind}"></head><p>x</p>{articles}<p>y</p>', articles=_two(_ARTICLE, columns), **columns)
    url = render("https://blog.example/posts?id={event}", **columns)
    return spread_events(spark, sf_dir).select(F.col("event_id").alias("page_id"), url.alias("url"), html.alias("html"))
