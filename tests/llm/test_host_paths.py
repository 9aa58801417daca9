import random

import pytest

from tessera.llm import host_paths as H
from tessera.llm.host_paths import Page, best_path, extract, host_of


def main_text(html):
    page = Page(html)
    return page.text(best_path(page.shares()))


@pytest.mark.parametrize("html, text", [
    ("", ""),
    ("<p>just &lt;text&gt; &amp; more", "just <text> & more"),
    ("<article><h1>T</h1><p>a<br>b</p>  <p>c\n\t d&nbsp;e</article>", "T a b c d e"),
    ("<p>one<p>two<ul><li>x<li>y</ul>z", "one two x y z"),
    ("<div><b>bo</b>ld <i>it</div>", "bold it"),
    ("<nav><p>menu</nav><main><p>body</main><footer>foot", "body"),
    ("<body><div class='ad x'>buy</div><div id=comments><p>troll</p></div><div class=post>text</div>", "text"),
    ("<script>var a='<p>no</p>'</script><style>p{}</style><title>no</title><p>yes", "yes"),
    ("<form><p>no</form><!-- <p>no</p> --><p hidden>no</p><p style='display: none'>no</p><p>yes</p>", "yes"),
    ("<a title=it's href='x>y'>link</a> 3 < 5 <p>next", "link 3 < 5 next"),
    ("<article><header><h1>Head</h1><p>by me</p></header><p>body<aside>no</aside></article>", "Head body"),
    ("<article><p>kept<script>if (a</b) x", "kept"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
    ("</p></div><p>stray ends</b></p>", "stray ends"),
    ("<article><p>cut in a tag <a hre", "cut in a tag"),
])
def test_text_of_a_page(html, text):
    assert main_text(html) == text


def test_paths_are_generalised():
    page = Page("<div id=w><div class='post p-17 b'><p>long text here</div><div class='post p-18 b'><p>more of it</div></div>")
    assert page.shares() == {"": 1.0, "div": 1.0, "div>div.b.p-#.post": 1.0}
    assert page.text(best_path(page.shares())) == "long text here more of it"


def test_host(spark):
    urls = {"https://A.example:8080/x?y": "a.example", "http://u:p@b.example#z": "b.example", "no url": "", None: "", "ftp://c": "c"}
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", host_of("u").alias("h")).collect()
    assert {r["u"]: r["h"] for r in rows} == urls


def site(host, n, r):
    """Pages whose side box is text too; on a few it is longer than the article."""
    rows = []
    for i in range(n):
        body = " ".join(f"body{r.randrange(999)}" for _ in range(12 if i % 10 == 0 else r.randrange(120, 300)))
        side = " ".join(f"side{r.randrange(99)}" for _ in range(14 if i % 10 == 0 else 2))
        rows.append((f"https://{host}/{i}", f"<html><body><div class=wrap><div class='c{i} text'><p>{body}</p></div><div class=box>{side}</div></div></body>", body))
    return rows


def test_hosts_agree_on_a_path(spark):
    r = random.Random(2)
    rows = [(i, *x) for i, x in enumerate(site("a.example", 200, r) + site("B.example:80", 30, r))]
    rows.append((999, "http://a.example/other", "<html><article><p>another template of the host</p></article>", "another template of the host"))
    df = spark.createDataFrame(rows, "page_id long, url string, html string, want string").repartition(4)
    got = {x["page_id"]: x for x in extract(df).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["text"] == want for i, _, _, want in rows)
    # alone, the pages with a long side box would have been read whole
    assert any(main_text(html) != want for _, _, html, want in rows)


def test_an_article_of_several_containers(spark):
    r = random.Random(5)
    rows = []
    for i in range(60):
        word = lambda n: " ".join(f"w{r.randrange(9999)}" for _ in range(n))  # noqa: E731, B023
        title, intro, end = word(5), word(12) + ".", word(9)
        body, more = (word(60), word(140)) if i % 20 == 0 else (word(400), word(4) + "!")
        html = (f"<body><div class=page><div class=post><h1>{title}</h1><div class=intro>{intro}</div><div class=body><p>{body}</p></div>"
                f"<div class=more>{more}</div><div class=x><p>{end}</p></div></div><div class=box>by me</div><div><a href=x>{word(30)}</a></div></div>")
        rows.append((i, f"http://h/{i}", html, " ".join([title, intro, body, more, end])))
    got = {x["page_id"]: x["text"] for x in extract(spark.createDataFrame(rows, "page_id long, url string, html string, want string")).collect()}
    assert all(got[i] == want for i, _, _, want in rows)


def test_a_host_with_two_templates(spark):
    r = random.Random(6)
    rows = []
    for i in range(100):
        body = " ".join(f"w{r.randrange(9999)}" for _ in range(12 if i % 10 == 0 else 200))
        side = f"<div class=box>{' '.join(f's{r.randrange(99)}' for _ in range(12 if i % 10 == 0 else 2))}</div><div class=y><p>Hosted by us.</p></div>"
        html = (f"<body><div class=a><div class=b><p>{body}</p></div>{side}</div>" if i % 10 < 7 else
                f"<body><div class=c>by me</div><div class=d><div class=e><p>{body}</p></div></div>{side}")
        rows.append((i, f"http://h/{i}", html, body, "div.a>div.b" if i % 10 < 7 else "div.d>div.e"))
    got = {x["page_id"]: x for x in extract(spark.createDataFrame(rows, "page_id long, url string, html string, want string, p string")).collect()}
    assert all((got[i]["text"], got[i]["path"]) == (want, path) for i, _, _, want, path in rows)


def test_pages_that_repeat_keep_their_text(spark):
    html = "<body><div class=t><h1>Title</h1></div><div class=b><p>" + "word " * 200 + "</p></div>"
    df = spark.createDataFrame([(i, "http://h/x", html) for i in range(5)], "page_id long, url string, html string")
    assert {r["text"] for r in extract(df).collect()} == {" ".join(["Title", *["word"] * 200])}


def test_much_text_outside_paragraphs_is_kept():
    lines = [f"line {i} of it" for i in range(8)]
    page = Page("<div class=a><p>" + "long text " * 100 + "</p></div>" + "".join(f"<div class=l>{x}</div>" for x in lines) + "<div class=b>by me</div>")
    assert page.text("div.a") == " ".join([*["long text"] * 100, *lines])
    assert page.left_out("div.a") < 0.01


def words(r, n):
    return " ".join(f"w{r.randrange(9999)}" for _ in range(n))


def test_the_host_decides_on_paths_beside_the_article(spark):
    """Side boxes, bylines and leads that only their host can tell apart."""
    r = random.Random(7)
    offers = [f"Buy our book {i} today. It is good." for i in range(3)]
    rows = []
    for i in range(60):
        lead, body, end = words(r, 6) + ("" if i % 4 == 0 else "."), words(r, 150), words(r, 12)
        byline = f"by {words(r, 2)}" + ("." if i % 3 == 0 else "")
        html = (f"<body><div class=k>{lead}</div><div class=by>{byline}</div><div class=box><p>{offers[i % 3]}</p></div>"
                f"<div class=post><p>{body}</p></div><div class=z><p>{end}</p></div>")
        rows.append((i, html, " ".join([lead, body, end])))
    together = spark.createDataFrame([(i, "http://one/", h, w) for i, h, w in rows], "page_id long, url string, html string, want string")
    got = {x["page_id"]: x["text"] for x in extract(together).collect()}
    assert [got[i] for i, _, _ in rows] == [w for _, _, w in rows]
    # the same pages, each its own host: no votes, and most texts are wrong
    apart = spark.createDataFrame([(i, f"http://h{i}/", h) for i, h, _ in rows], "page_id long, url string, html string")
    alone = {x["page_id"]: x["text"] for x in extract(apart).collect()}
    assert all(alone[i] != w for i, _, w in rows)


def test_copied_pages_keep_their_second_body(spark):
    r = random.Random(8)
    rows = [(f"<body><div class=post><p>{b}</p></div><div class=z><p>{e}</p></div><div class=box><p>Buy this. It is good.</p></div>", f"{b} {e}")
            for b, e in ((words(r, 90), words(r, 20)) for _ in range(10))] * 6
    df = spark.createDataFrame([(i, "http://h/", *x) for i, x in enumerate(rows)], "page_id long, url string, html string, want string")
    assert {(x["page_id"], x["text"]) for x in extract(df).collect()} == {(i, w) for i, (_, w) in enumerate(rows)}


def plain(rows):
    """The votes counted in dictionaries, one host after the other."""
    hosts = {}
    for i, host, html in rows:
        hosts.setdefault(host, []).append((i, Page(html or "")))
    out = {}
    for pages in hosts.values():
        votes, reads, digests = {}, {}, {}
        for _, page in pages:
            shares = page.shares()
            if shares:
                chosen = H.vote(shares)
                votes[chosen] = votes.get(chosen, 0) + 1
            for p, yes in page.parts().items():
                reads.setdefault(p, []).append(yes)
            for p, d in page.digests().items():
                digests.setdefault(p, []).append(d)
        enough = max(H.VOTES, sum(votes.values()) * H.FEW)
        wins = sorted((p for p in votes if p and votes[p] >= enough), key=lambda p: (-votes[p], -p.count(">"), p))
        words_on = {}
        if wins:
            varied = min(len(set(digests[p])) / len(digests[p]) for p in wins)
            for p, ds in digests.items():
                yes = reads.get(p, [])
                if p and len(ds) >= max(H.SAME, enough) and len(set(ds)) * H.SAME <= len(ds) * varied:
                    words_on[p] = False
                elif len(yes) >= enough:
                    words_on[p] = sum(yes) * 2 > len(yes)
                if p in wins and words_on.get(p) is False:
                    del words_on[p]
        for i, page in pages:
            shares = page.shares()
            own = best_path(shares)
            path = next((p for p in wins if shares.get(p, 0) >= H.LEAST), own)
            tries = [(path, words_on), (own, words_on)]
            path, heard = next((t for t in tries if page.left_out(*t) <= H.MUCH), (own, None))
            out[i] = (page.text(path, heard), path)
    return out


def test_random_sites_equal_plain_counts(spark):
    r = random.Random(9)
    rows = []
    for i in range(400):
        host = r.choice(["a", "a", "a", "b", "c", f"x{r.randrange(40)}"])
        blocks = []
        for _ in range(r.randrange(6)):
            name = r.choice(["post", "k", "z", "box", "lead", "q q1", "n"])
            text = r.choice([words(r, r.choice([2, 5, 30])), "Same words here.", "Same label", "<a href=x>" + words(r, 4) + "</a>"])
            inner = r.choice(["{}", "<p>{}</p>", "{}.", "<div class=in>{}</div>", "<h2>T</h2>{}"]).format(text)
            blocks.append(f"<div class='{name}'>{inner}</div>")
        rows.append((i, host, r.choice(["", "<h1>Head</h1>", "lone"]) + "".join(blocks)))
    df = spark.createDataFrame([(i, f"http://{h}/{i}", html) for i, h, html in rows], "page_id long, url string, html string").repartition(5)
    assert {x["page_id"]: (x["text"], x["path"]) for x in extract(df).collect()} == plain(rows)


def test_odd_rows(spark):
    long = "<article>" + "".join(f"<p>par {i} of text</p>" for i in range(20_000))
    rows = [(1, None, None), (1, None, None), (None, "http://x/", ""), (2, "no url", "<p>a"), (3, "http://x/1", long), (3, "http://x/1", long), (4, "", "plain")]
    df = spark.createDataFrame([(*x, "t", "p", "h") for x in rows], "page_id long, url string, html string, text string, path string, host string")
    got = sorted(((r["page_id"] or 0, r["url"], len(r["text"])) for r in extract(df).collect()), key=str)
    n = len(" ".join(f"par {i} of text" for i in range(20_000)))
    assert got == sorted([(1, None, 0), (1, None, 0), (0, "http://x/", 0), (2, "no url", 1), (3, "http://x/1", n), (3, "http://x/1", n), (4, "", 5)], key=str)
    assert extract(df.where("page_id = -1")).count() == 0


def test_no_article_text_is_lost_to_a_word_or_a_letter():
    def text(html):
        return " ".join(b[1] for b in Page(html).blocks)
    chapters = "<article><div class='social-history'><p>One.</p></div><section id='form-of-government'><p>Two.</p></section></article>"
    assert text(chapters) == "One. Two."
    boxes = "<article><p>One.</p><div class='social'>x</div><div class='related-posts'>x</div><div class='comment-list'>x</div><div class='ad-box'>x</div></article>"
    assert text(boxes) == "One."
    # 30 letters whose lower case is longer, before a script
    page = "<p>" + "\u0130stanbul " * 30 + "</p><SCRIPT>if (a < b) {}</ScRiPt ><p>Hello world text here, all.</p>"
    assert text(page).endswith("Hello world text here, all.")
    assert text("<p>a</p><script>never closed <p>b</p>") == "a"
