"""Centroid clustering, change points and main texts against brute force, SQL, and on odd rows."""

import hashlib
import math
import random
import time
from datetime import datetime, timedelta

import duckdb
import numpy as np
import pytest

from millrace.llm import centroids as cen, change_points as cp, html_text as ht

SF = "/root/testdata/sf0.001"


def same_as_sql(df, sql, **tables):
    """Rows of df equal those of DuckDB's SQL over parquet files or frames."""
    db = duckdb.connect()
    for name, t in tables.items():
        db.register(name, t) if not isinstance(t, str) else db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{t}'")
    found = db.execute(sql)
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(map(repr, (tuple(r) for r in df.select(names).collect()))) == sorted(map(repr, found.fetchall()))


# centroids


def integer(x):
    return 64 * int(x) if abs(x) > 1e300 else math.floor(64 * float(x))


@pytest.mark.parametrize("seed", range(60))
def test_nearest_equals_integers_at_any_magnitude(seed):
    draw = np.random.default_rng(seed)

    def vectors(n):
        return draw.normal(size=(n, 5)) * 10.0 ** draw.choice([0, 0, 0, 3, 5, 6, 7, 8, 9, 12, 18, 30, 304], size=(n, 1))

    x = vectors(draw.integers(1, 20))
    centres = [[integer(v) for v in r] for r in (vectors(4) if seed % 3 else draw.normal(size=(4, 5)))]
    centres.append(list(centres[1]))  # a tie
    label, distance = cen.nearest(x, centres)
    for row, at, d in zip(x, label, distance, strict=True):
        assert (d, at) == min((sum((integer(v) - c) ** 2 for v, c in zip(row, centre, strict=True)), j) for j, centre in enumerate(centres))


def brute_clusters(rows, k=16, rounds=3):
    kept = [(i, [integer(x) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), j) for j, c in enumerate(centres))

    for _ in range(rounds):
        at = [near(v)[1] for _, v in kept]
        for j in range(len(centres)):
            own = [v for (_, v), a in zip(kept, at, strict=True) if a == j]
            if own:
                centres[j] = [sum(x) // len(own) for x in zip(*own, strict=True)]
    found = [(i, *near(v)) for i, v in kept]
    of = {j: sum(d for _, d, a in found if a == j) for j in range(len(centres))}
    long = lambda v: v if v < 1 << 63 else None
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, a, long(d), long(of[a]), long(sum(of.values())), sha[a]) for i, d, a in found), key=repr)


@pytest.mark.parametrize("huge", [False, True])
def test_clusters_equal_brute_force_on_odd_rows(spark, huge):
    draw = random.Random(4)
    rows = [(i, [draw.gauss(draw.choice([-1, 0, 1]), 0.3) for _ in range(64)]) for i in range(60)]
    rows += [(60, None), (61, []), (62, [1.0] * 63), (63, [None] + [1.0] * 63), (64, [math.nan] * 64), (65, [math.inf] * 64), (None, [0.5] * 64), (3, rows[3][1]), (4, [0.25] * 64)]
    if huge:
        rows += [(70, [1e300] * 64), (71, [-3e18] + [0.0] * 63), (72, [2e7] * 64), (73, [1.7e308] * 64)]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, cluster string, distance int").repartition(5)
    got = cen.cluster(df).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    assert sorted(map(tuple, got), key=repr) == brute_clusters(rows)


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {r.distance for r in cen.cluster(df).collect()} == {0}
    assert cen.cluster(df.where("vec_id > 9")).collect() == []


def test_clusters_of_the_table_equal_sql(spark):
    same_as_sql(cen.op11(spark, SF), cen.SQL, embeddings=f"{SF}/embeddings.parquet")


# change points


def best_cuts(y, least, penalty):
    """By trying all segmentations."""

    def cost(a, b):
        n, s, q = b - a, sum(y[a:b]), sum(x * x for x in y[a:b])
        return n * math.floor(1000 * math.log(1 + (n * q - s * s) // (n * n)))

    best = None

    def before(end, starts, total):
        nonlocal best
        for s in [0, *range(least, end - least + 1)]:
            if s and s > end - least:
                continue
            if s == 0:
                at = (total + cost(0, end) + penalty * len(starts), len(starts) + 1, [*starts, 0])
                best = min(best or at, at)
            else:
                before(s, [*starts, s], total + cost(s, end))

    before(len(y), [], 0)
    return best[0], best[2][::-1]


@pytest.mark.parametrize("seed", range(80))
def test_cut_points_equal_all_segmentations(seed):
    draw = random.Random(seed)
    n, levels = draw.randint(1, 34), [draw.choice([0, 1, 5, 50]) for _ in range(5)]
    y = [draw.choice([0, 0, 0, 4]) if seed % 3 == 0 else draw.randint(0, 3) + levels[i // 7] * draw.randint(1, 3) for i in range(n)]
    penalty = draw.choice([0, 500, 3000, 20000])
    points, total = cp.cut_points(cp.Series(np.array(y)), 7, penalty)
    assert (total, points[:-1]) == best_cuts(y, 7, penalty) and points[-1] == n


def test_sums_beyond_64_bits_and_small_blocks(monkeypatch):
    draw = random.Random(1)
    y = [draw.randint(0, 9) << 50 if i < 15 else draw.randint(0, 9) << 20 for i in range(30)]
    points, total = cp.cut_points(cp.Series(np.array(y)), 7, 20000)
    assert (total, points[:-1]) == best_cuts(y, 7, 20000)
    y = [draw.randint(0, 40) * (1 + i // 30) for i in range(140)]
    whole = cp.cut_points(cp.Series(np.array(y)), 7, 3000)
    monkeypatch.setattr(cp, "BLOCK", 900)
    assert cp.cut_points(cp.Series(np.array(y)), 7, 3000) == whole and len(whole[0]) > 3


def sale_lines(spark):
    draw, day = random.Random(2), datetime(2024, 1, 1)
    rows = [(v, draw.choice([None, 1, 2, draw.randint(1, 50)]), draw.choice(["kept", "kept", "returned", None]), draw.choice([None, day + timedelta(hours=draw.randint(0, 24 * 90))])) for v in (1, 1, 1, 2, 2, None) for _ in range(150)]
    rows += rows[:40] + [(3, 5, "kept", day), (4, 5, "kept", day), (4, 6, "kept", day + timedelta(days=3)), (5, None, "kept", day), (6, 9, "kept", day), (6, 9, "kept", day + timedelta(days=80))]
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "vendor_id long, quantity int, flag string, shipped_at timestamp_ntz, total string, day int")


def test_segments_equal_sql_on_odd_rows(spark, tmp_path):
    sale_lines(spark).write.parquet(str(tmp_path / "sale_lines.parquet"))
    got = cp.op12(spark, str(tmp_path))
    assert got.where("vendor_id = 3").count() == 1 and got.where("vendor_id = 5").count() == 0 and got.where("vendor_id IS NULL").count() > 0
    same_as_sql(got, cp.SQL, sale_lines=f"{tmp_path}/sale_lines.parquet/*.parquet")
    assert cp.change_points(spark.read.parquet(f"{tmp_path}/sale_lines.parquet").where("false"), "vendor_id", "shipped_at", "quantity").collect() == []


def test_segments_of_the_table_equal_sql(spark):
    same_as_sql(cp.op12(spark, SF), cp.SQL, sale_lines=f"{SF}/sale_lines.parquet")


def test_only_daily_sums_are_shuffled(spark):
    plan = cp.op12(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 2 and plan.index("partial_sum") > plan.index("Exchange")


# main texts

WORDS = "This is a fairly long paragraph of an article with several words in it, number"


def article(n, first=0):
    return "".join(f"<p>{WORDS} {i}.</p>" for i in range(first, first + n)), [f"{WORDS} {i}." for i in range(first, first + n)]


COMMENT = "<p>A reader says much more than the article does, and goes on and on about it all day long. </p>" * 9
CHROME = {
    "menus": "<nav><ul><li><a href=/a>One</a><li><a href=/b>Two</a></ul></nav><div class=main-menu>Three</div><div role='navigation'>Four</div>",
    "header": "<header><h1>The site</h1><p>Its motto is long enough to look like a text of its own.</p></header><div id=masthead>Site</div>",
    "footer": "<footer>&copy; Someone <p>who writes a long line about all rights that are reserved here.</footer>",
    "sidebar": f"<aside>{COMMENT}</aside><div class='left sideBar'>{COMMENT}</div><div role=complementary>More</div>",
    "notice": "<div class='cookie-notice'>We use cookies on this page, and tell you so at some length.</div><div id=noticeBox>Hear!</div>",
    "advert": "<div class=ad>Buy this now, it is as cheap as it will ever be in your whole life.</div><div class='ad-slot top'>Buy</div>",
    "form": "<form action=/s><label>Mail</label><input name=m><textarea>dear <b>you</b></textarea><button>Send</button></form>",
    "script": "<script>document.write('<p>no</p>')</script><style>p{margin:0}</style><noscript><p>Turn it on</p></noscript><template><p>x</p></template>",
    "comments": f"<section id=comments><h2>Comments</h2><article class=comment>{COMMENT}</article></section><div class=comment-list>{COMMENT}</div>",
    "hidden": "<div hidden>hid</div><div style='display: none'>den</div><p aria-hidden=true>x</p>",
    "links": "<ul>" + "<li><a href=/x>Another article of this site</a></li>" * 5 + "</ul>",
    "markup": "<!-- <p>no</p> --><?php echo 1 ?><![CDATA[x]]>",
}


@pytest.mark.parametrize("what", list(CHROME))
@pytest.mark.parametrize("frame", ["<article>{}</article>", "<main>{}</main>", "<div class=content>{}</div>", "<div class='page has-sidebar'><div class=text>{}</div></div>", "<main><article>{}</article></main>", "<table><tr><td>{}</table>"])
def test_chrome_goes_and_the_article_stays(what, frame):
    text, want = article(6)
    body = frame.format(f"<h1>A title</h1>{text}")
    for page in (f"{CHROME[what]}{body}", f"{body}{CHROME[what]}"):
        html = f"<!doctype html><html><head><title>No</title></head><body class='no-sidebar'>{page}</body></html>"
        assert ht.main_text(html).split("\n") == ["A title", *want], html


@pytest.mark.parametrize("what", ["notice", "advert", "form", "script", "comments", "hidden", "markup", "links", "sidebar", "footer"])
def test_chrome_inside_an_article_goes(what):
    (a, x), (b, y) = article(3), article(4, 3)
    assert ht.main_text(f"<body><article><header><h1>A title</h1></header>{a}{CHROME[what]}{b}</article></body>").split("\n") == ["A title", *x, *y]


@pytest.mark.parametrize(
    ("html", "text"),
    [
        (None, ""), ("", ""), ("   ", ""), ("plain", "plain"), ("<p>a<p>b&nbsp;&amp;c<br>d", "a\nb &c d"), ("<article>Direct <b>text</b>.<p>x</article>", "Direct text.\nx"),
        ("<article><p>a <script>1</script>b</p>c<hr>d</article>", "a b\nc\nd"), ("<p>&lt;b&gt; &#x41;&#0; &unknown; &copy</p>", "<b> A� &unknown; ©"), ("<p>x</p></body></html>tail", "x\ntail"),
        ("<article><h1>T</h1><p><b>t<br><p>u</article>", "T\nt\nu"), ("<article><h1>Short</h1></article><div>Something much longer than it</div>", "Short\nSomething much longer than it"),
        ("<article><ul><li>one<li>two<ul><li>three</ul></ul></article>", "one\ntwo\nthree"), ("<article>a</i></b></div>b</article>", "ab"), ("<p>cut <a hre", "cut"), ("<article><table><tr><td>a<td>b</table></article>", "a\nb"),
        ("<body>" + "<div>" * 3 + "<p>deep</p>", "deep"), ("<article><pre> a\n  b </pre></article>", "a b"), ("<title>only</title>", ""),
    ],
)
def test_texts_of_small_pages(html, text):
    assert ht.main_text(html) == text


def test_sections_of_an_article_without_a_name_all_stay():
    (a, x), (b, y) = article(9), article(4, 9)
    page = f"<body><div class=wrap><h1>A title</h1><div>{a}</div><h2>More</h2><div>{b}</div></div><div class=teasers><a href=1>Short</a></div></body>"
    assert ht.main_text(page).split("\n")[-13:] == [*x, "More", *y] or ht.main_text(page).split("\n") == ["A title", *x, *y]


@pytest.mark.parametrize("piece", ["<div>", "<p>", "<b></i>", "<li>", "<td>", "<a href=x>y</a>", "<b>", "</p>", "<br>", "<script ", "<table><tr><td>"])
def test_main_text_takes_linear_time(piece):
    def seconds(size):
        page, began = "<body>" + piece * (size // len(piece)), time.process_time()
        ht.main_text(page)
        return time.process_time() - began

    assert seconds(400_000) < 40 * seconds(40_000) + 0.1


def test_long_page_and_odd_rows(spark):
    text, want = article(20000)
    rows = [(1, "u", f"<article>{text}</article>", 5), (None, None, None, 6), (2, "v", "", 7), (2, "v", "<p>x", 8)]
    df = spark.createDataFrame([(*r, "own") for r in rows], "page_id long, url string, html string, n_chars int, `Text` string")
    got = {(r.page_id, r.html): (r.text, r.n_chars) for r in ht.with_text(df).collect()}
    assert got[1, rows[0][2]] == ("\n".join(want), len("\n".join(want)))
    assert got[None, None] == got[2, ""] == ("", 0) and got[2, "<p>x"] == ("x", 1)
    assert ht.with_text(df.where("false")).collect() == []


def test_main_texts_of_the_table_equal_sql(spark):
    same_as_sql(ht.op13(spark, SF), ht.SQL, pages=f"{SF}/pages.parquet")
