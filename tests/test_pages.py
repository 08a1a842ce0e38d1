"""Golden pages of the three kinds."""

from twosided.functions.html import Field, Step, page_fields, page_records
from twosided.plans import pages

ROUND = """<html><body><div class="panel-title">Matchday 12 of 38</div><a class="match-link" href="/no">outside</a>
<div class="panel-body p0 match-list-new">
<a class="match-link big" href="/match/a/b/2023"><div class="team-info ta-r"><div class="name"> A &amp; Co </div></div>
<div class="marker"><span class="r1">2</span>-<span class="r2"> 1 </span></div>
<div class="team-info"><div class="name">B</div></div></a>
<a class="match-link" href="/match/c/d/2023"><div class="team-info ta-r"><div class="name">C</div></div>
<div class="marker">20:00</div><div class="team-info"><div class="name">D</div></div></a></div></body></html>"""

RATING = """<div class="panel-body pn compare-data"><table><tr><th>x</th></tr>
<tr><td class="team1-c"> 81 </td><td>ELO</td></tr></table></div>"""

CARDS = """<div class="date header-match-date no-hour"> SAT, 12 AUG </div><div class="date header-match-date">SUN, 13 AUG
</div><div>On field referee</div><p><b>J. Doe</b> </p>
<div class="cards"><span class="yc">3</span></div><div class="cards"><span class="yc">1</span><span class="rc">2</span></div>"""


def test_round_results(spark):
    df = spark.createDataFrame([(2023, 12, "serie_a", ROUND), (2023, 13, "serie_a", "<p>none</p>")],
                               "season_year int, match_round int, league string, html string")
    got = sorted((r.home_team, r.away_team, r.score, r.link, r.match_round) for r in pages.round_results(df).collect())
    assert got == [("A & Co", "B", "2-1", "/match/a/b/2023", 12), ("C", "D", "N/A-N/A", "/match/c/d/2023", 12)]
    rounds = {r.match_round: r.rounds for r in pages.number_of_rounds(df, ["match_round"]).collect()}
    assert rounds == {12: 12, 13: None}


def test_contest_ratings(spark):
    df = spark.createDataFrame([("a", RATING), ("b", "<p>x"), ("c", None)], "link string, html string")
    got = {r.link: (r.home_elo, r.away_elo) for r in pages.contest_ratings(df).collect()}
    assert got == {"a": ("81", "N/A"), "b": ("N/A", "N/A")}


def test_contest_cards(spark):
    df = spark.createDataFrame([("a", 2023, CARDS), ("b", 2023, "")], "link string, season_year int, html string")
    got = {r.link: r for r in pages.contest_cards(df).collect()}
    a, b = got["a"], got["b"]
    assert (str(a.date), a.referee) == ("2023-08-13", "J. Doe")
    assert (a.home_yellow, a.home_red, a.away_yellow, a.away_red) == (3.0, 0.0, 1.0, 2.0)
    assert (b.date, b.referee, b.home_yellow) == (None, "N/A", 0.0)


def test_records_attributes_and_defaults(spark):
    df = spark.createDataFrame([(1, "<ul><li id=x>a<li>b<br>c</ul><li>d")], "i int, html string")
    fields = {"t": Field(), "id": Field(attribute="id", default="-")}
    got = [(r.place, r.t, r.id) for r in page_records(df, ["i"], fields, Step("li"), [Step("ul")]).collect()]
    assert got == [(0, "abc", "x"), (1, "bc", "-")]
    assert page_fields(df, ["i"], {"z": Field([Step("p")], default=None)}).first().z is None


def test_deep_pages_are_read(spark):
    deep = "<div>" + "<p>x" * 5000 + "</div><b>end</b>"
    df = spark.createDataFrame([(1, deep)], "page_id long, html string")
    row = page_fields(df, ["page_id"], {"end": Field([Step("b")]), "first": Field([Step("p")])}).first()
    assert row.end == "end" and row.first == "x" * 5000
