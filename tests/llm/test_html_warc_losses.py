"""Nothing of an article and no record goes unseen."""

import random
import re

import pytest

from geospan.llm import html, warc

LONG = "A long, long sentence of the main text, with commas, and more, and yet more."


@pytest.mark.parametrize("page, want", [
    (f"<body><nav><a href=x>menu</a></nav><article><p>{LONG}</p><section class='related-work'><h2>Work before</h2><p>{LONG}</p></section>"
     f"<div class='legal'><p>The legal side of this, in a sentence, is a long one indeed.</p></div><details class='more'><p>{LONG}</p></details>"
     f"<div class='comments'><p>{LONG}</p></div><div class='cookie-notice'><p>{LONG}</p></div><div class='related'><a href=x>Other article.</a></div></article></body>",
     f"{LONG}\nWork before\n{LONG}\nThe legal side of this, in a sentence, is a long one indeed.\n{LONG}"),
    (f"<body><div class=wrap>Lead-in of the text, as bare words. <div id=content><p>{LONG}</p><p>{LONG}</p></div> And some <b>closing</b> words.</div></body>",
     f"Lead-in of the text, as bare words.\n{LONG}\n{LONG}\nAnd some closing words."),
    (f"<body>Menu | <a href=x>Home</a><div id=content><p>{LONG}</p></div>© 2020 Somebody.</body>", LONG),
    (f"<article><p>Press the <button>Save</button> key, and {LONG}</p><p><button>Share</button></p></article>", f"Press the Save key, and {LONG}"),
    (f"<article><div class='entry-header'><h1>The title of an article, and a long one at that</h1></div><p>{LONG}</p></article>",
     f"The title of an article, and a long one at that\n{LONG}")])
def test_article_text_is_kept(page, want):
    assert html.main_text(page) == want


def test_long_pages_and_ties():
    page = "<div id=a>" + "".join(f"<p>{LONG} {k}</p>" for k in range(20_000)) + "</div>"
    assert html.main_text(page).count("\n") == 19_999
    assert html.main_text("<div class=side>" * 2000 + f"<p>{LONG}</p>") == LONG
    twins = f"<body><div><p>{LONG}</p></div><div><p>{LONG}</p></div></body>"
    assert html.main_text(twins) == html.main_text(twins) == f"{LONG}\n{LONG}"


def test_every_block_of_plain_articles_is_kept():
    """Against a naive reading: the blocks of the article's own markup, whatever stands around it."""
    rng = random.Random(3)
    for _ in range(100):
        words = lambda: " ".join("".join(rng.choice("abcdefg") for _ in range(rng.randrange(1, 8))) for _ in range(rng.randrange(5, 40)))
        inside = [rng.choice([f"<p>{{}}, {{}}.</p>", "<h2>{} {}</h2>", "<ul><li>{}</li><li>{}</li></ul>", "<blockquote>{}, <i>{}</i></blockquote>",
                              "<table><tr><td>{}</td><td>{}</td></tr></table>"]).format(words(), words()) for _ in range(rng.randrange(3, 9))]
        page = (f"<body><nav><a href=x>{words()}</a></nav><div class=sidebar><p>{words()}</p></div><article>{''.join(inside)}</article>"
                f"<div id=comments><p>{words()}, {words()}.</p></div><footer>{words()}</footer></body>")
        naive = [re.sub(r"<[^>]*>", "", b) for part in inside for b in re.split(r"</(?:li|td)>", part)]
        assert html.main_text(page).split("\n") == [b.strip() for b in naive if b.strip()]


def archive(tmp_path, members):
    path = tmp_path / "x.warc.gz"
    path.write_bytes(b"".join(members))
    return str(path), path.stat().st_size


def one(i, size=3000):
    payload = random.Random(i).randbytes(size)
    return warc.record(i, f"u{i}", payload, size, __import__("hashlib").sha1(payload).hexdigest(), "response", None, "2020-01-01T00:00:00Z")


def read_all(path, size, step, flag):
    out = []
    for a in range(0, size, step):
        out += list(warc.records(warc.ByteRange(f"file://{path}", size, step=512), a, min(a + step, size), flag))
    return [r["fields"]["x-page-id"] if "fields" in r else "damaged" for r in out]


@pytest.mark.parametrize("step", [700, 1 << 20])
def test_damaged_records_are_seen(tmp_path, step):
    rows = [one(1), one(2), one(3)]
    path, size = archive(tmp_path, rows)
    assert read_all(path, size, step, False) == ["1", "2", "3"]
    start = len(rows[0])
    for at in (start + 1, start + 4, start + 12, start + 40, start + 1500, start + len(rows[1]) - 6):
        data = bytearray(b"".join(rows))
        data[at] ^= 0x55
        if bytes(data) == b"".join(rows):
            continue
        path, size = archive(tmp_path, [bytes(data)])
        try:
            seen = read_all(path, size, step, False)
        except warc.Damaged:
            pass
        else:  # some header bytes (time, system) mean nothing
            assert seen == ["1", "2", "3"] and at == start + 4
        seen = read_all(path, size, step, True)
        assert [x for x in seen if x != "damaged"] in (["1", "3"], ["1", "2", "3"]) and ("damaged" in seen or seen == ["1", "2", "3"])
    for cut in (1, 10, 2000, len(rows[2]) - 5):
        path, size = archive(tmp_path, [rows[0], rows[1], rows[2][:-cut]])
        with pytest.raises(warc.Damaged):
            read_all(path, size, step, False)


def test_read_flags_or_raises(spark, tmp_path):
    data = bytearray(one(1) + one(2) + one(3))
    data[len(one(1)) + 700] ^= 1
    archive(tmp_path, [bytes(data)])
    rows = warc.read(spark, str(tmp_path), damaged="flag").collect()
    assert sorted(r["page_id"] or 0 for r in rows) == [0, 1, 3] and [r["record_type"] for r in rows].count("damaged") == 1
    with pytest.raises(Exception, match="record at byte"):
        warc.read(spark, str(tmp_path)).collect()
