from __future__ import annotations

import random

import pytest

from lodestar.llm.html_extraction import host_of, intervals, main_text, read_page

SCHEMA = "page_id long, url string, html string, text string, tokens string"


@pytest.mark.parametrize(
    "page,want",
    [
        (None, ""),
        ("", ""),
        ("<html><head><title>T</title></head><body><nav>menu</nav><article><h1>A &amp; B</h1><p>one<br>two<p>th<b>re</b>e&nbsp;x</article><footer>f</footer>", "A & B\none two\nthree x"),
        ("<article><p>a<div class='ad'>buy</div><p>b<aside>c</aside><form>d</form><script>var t='</p>'</script><style>p{}</style><!-- no --></article>", "a\nb"),
        ("<article>x<section class='comments'><article>reader</article></section><div class='cookie-notice'>c</div></article>", "x"),
        ("<main><p>m</p></main><article class='comment'>r</article>", "m"),
        ("<article>short</article><article>the longer one</article>", "the longer one"),
        ("<div id=sidebar>s</div><p>loose &lt;text&gt;</p><div role='navigation'>n</div>", "loose <text>"),
        ("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table><p>a < b and c > d</article>", "a\nb\nc\nd\na < b and c > d"),
        ("<article><p class='lead' title=\"a > b\">q</p></article>", "q"),
    ],
)
def test_pages(spark, page, want):
    article, others = read_page(page)
    assert "\n".join(others if article is None else article) == want


def test_unmarked_pages_lose_what_their_host_repeats(spark):
    shared = "all rights kept by the site and its friends for ever"
    own = [" ".join(f"w{i}x{k}" for k in range(8)) for i in range(4)]
    rows = [(i, f"http://h.example/{i}", f"<p>{own[i]}</p><p>{shared}</p>") for i in range(4)]
    rows += [(10, "http://other.example/", f"<p>{shared}</p>"), (11, None, "<article>kept</article>"), (12, "x", None), rows[0]]
    rows += [(20 + i, f"http://h.example/a{i}", f"<article><p>{shared}</p></article>") for i in range(2)]
    df = spark.createDataFrame([(*r, "t", "h") for r in rows], SCHEMA).repartition(3)
    got = {r["page_id"]: r for r in main_text(df).collect()}
    assert main_text(df).count() == len(rows)
    assert [got[i]["text"] for i in range(4)] == own
    assert got[10]["text"] == shared and got[11]["text"] == "kept" and got[12]["text"] == ""
    assert got[20]["text"] == shared and got[20]["n_chars"] == len(shared)


def test_empty(spark):
    assert main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_host():
    assert host_of("HTTP://u@A.example:80/x?y") == "a.example" and host_of(None) == "" and host_of("//b.example#f") == "b.example"


def test_intervals_are_those_of_all_suffixes():
    r = random.Random(2)
    streams = [(r.choice("ab"), [r.choice("xyz") for _ in range(r.randrange(30))]) for _ in range(12)]
    want = {}
    for i, (host, tokens) in enumerate(streams):
        for k in range(len(tokens) - 3):
            want.setdefault((host, " ".join(tokens[k : k + 4])), []).append(i)
    got = {(streams[of[0]][0], tokens): sorted(of) for tokens, of in intervals(streams, 4)}
    assert got == {k: sorted(v) for k, v in want.items()} and intervals([], 4) == [] and intervals([("a", ["x"])], 4) == []


def brute(rows, run):
    """Every run of tokens that stands in two distinct pages of a host is cut from the host's unmarked pages."""
    blocks = {row: read_page(row[2]) for row in set(rows)}
    runs = {}
    for row, (_, others) in blocks.items():
        t = [w for b in others for w in b.split()]
        for i in range(len(t) - run + 1):
            runs.setdefault((host_of(row[1]), tuple(t[i : i + run])), set()).add(row)
    out = []
    for row in rows:
        article, others = blocks[row]
        if article is not None:
            text = "\n".join(article)
        else:
            t = [(w, n) for n, b in enumerate(others) for w in b.split()]
            cut = set()
            for i in range(len(t) - run + 1):
                if len(runs[host_of(row[1]), tuple(w for w, _ in t[i : i + run])]) > 1:
                    cut |= set(range(i, i + run))
            kept = {}
            for i, (w, n) in enumerate(t):
                if i not in cut:
                    kept.setdefault(n, []).append(w)
            text = "\n".join(" ".join(kept[n]) for n in sorted(kept))
        out.append((row[0], row[1], text, len(text)))
    return sorted(out, key=str)


def test_equals_brute_force_over_mixed_hosts(spark, monkeypatch):
    monkeypatch.setattr("lodestar.llm.common.HOT_ROWS", 3)
    r = random.Random(4)
    phrases = [" ".join(f"p{k}.{i}" for i in range(r.randrange(3, 14))) for k in range(12)]
    rows = []
    for i in range(160):
        host = "hot" if i % 3 == 0 else r.choice(["a", "b", "c"])
        parts = [r.choice(phrases) if r.random() < 0.5 else " ".join(f"u{r.randrange(30)}" for _ in range(r.randrange(1, 12))) for _ in range(r.randrange(1, 7))]
        body = "".join(f"<p>{p}</p>" for p in parts)
        if r.random() < 0.4:
            body = f"<article><p>{r.choice(phrases)}</p><p>own {i}</p></article>" + body
        rows.append((i, f"http://{host}.example/{i}" if i % 20 else None, f"<nav>{phrases[0]}</nav>{body}"))
    rows += rows[:4] + [(500, "http://a.example/", None), (501, "http://a.example/", ""), (None, "http://b.example/", f"<p>{phrases[1]}</p>")]
    rows.append((502, "http://a.example/long", "<div>" + "<p>long one</p>" * 50_000 + "</div>"))
    df = spark.createDataFrame([(*x, "t", "h") for x in rows], SCHEMA).repartition(5)
    got = sorted(map(tuple, main_text(df).collect()), key=str)
    assert got == brute(rows, 6)
    assert sorted(map(tuple, main_text(df, run=1 << 30).collect()), key=str) != got  # without the array the runs stay
