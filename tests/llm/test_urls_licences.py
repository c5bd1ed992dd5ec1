import re
import textwrap
from pathlib import Path

import pytest

from viewlens.llm import licences, urls


@pytest.mark.parametrize(
    ("url", "host", "path", "rule", "verdict"),
    [
        ("http://A.Example.NET/de/1?x#y", "a.example.net", "/de/1", "net/", "block"),
        ("https://example.net/en/1", "example.net", "/en/1", "example.net/en/", "allow"),
        ("http://example.com/de/", "example.com", "/de/", "example.com/de/", "block"),
        ("http://example.com/den", "example.com", "/den", None, None),
        ("http://notexample.net", "notexample.net", "", None, None),
        ("http://x.org/fr/#top", "x.org", "/fr/", "org/fr/", "allow"),
        ("http://org/fr/", "org", "/fr/", "org/fr/", "allow"),
        ("http://ÄB.net/\nz", "Äb.net", "/\nz", "net/", "block"),
        ("a://b://c/d", "b:", "//c/d", None, None),
        ("no scheme", "", "", None, None),
        (None, "", "", None, None),
    ],
)
def test_rules(spark, url, host, path, rule, verdict):
    df = spark.createDataFrame([(1, url, "h")], "page_id long, url string, host string")
    row = urls.judge_urls(df, keep=["page_id"]).first()
    assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
    assert row["verdict"] == verdict if verdict else row["verdict"] in ("allow", "block")
    assert urls.split_url(url) == (host, path)


def test_model_tells_unseen_hosts_apart(spark):
    rows = [("http://pills-casino.example.com/en/3", "block"), ("http://garden.example.com/en/3", "allow")]
    df = spark.createDataFrame(rows, "url string, wanted string")
    judged = urls.judge_urls(df, keep=["wanted"]).collect()
    assert [r["verdict"] for r in judged] == [r["wanted"] for r in judged]


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge_urls(empty).count() == 0
    one = spark.createDataFrame([("http://a/b",)], "url string")
    assert urls.judge_urls(one, labelled=()).first()["score"] == 0.5


def test_variants_of_a_licence_match(spark, documents):
    mit = licences.KNOWN[0][1]
    rows = [
        (1, mit),
        (2, "Copyright (c) 2020 Someone\n\n" + mit.upper().replace(",", " ,")),
        (3, mit + " more"),
        (4, "The licence:\nReleased under the MIT Licence!\n© 1999 A\n"),
        (5, None), (6, ""), (7, "..."), (None, "Released under the MIT License."), (1, mit),
    ]
    out = {r["doc_id"]: r for r in licences.scan_licences(documents(rows)).collect()}
    assert [out[i]["license_id"] for i in (1, 2, 3, 4, 5, None)] == ["MIT", "MIT", None, None, None, "MIT"]
    assert out[4]["notices"] == "MIT" and out[4]["n_lines"] == 2
    assert len({out[i]["digest"] for i in (5, 6, 7)}) == 1 and out[7]["n_lines"] == 0
    assert len(out) == 8
    assert licences.scan_licences(documents(rows).limit(0)).count() == 0


def test_no_known_licences(spark, documents):
    known = spark.createDataFrame([(None, "a"), ("x", None)], "license_id string, text string")
    assert licences.scan_licences(documents([(1, "a")]), known).first()["license_id"] is None


LICENCE_FILES = {
    "Apache-2.0": "Apache-2.0", "BSD": "BSD-3-Clause", "CC0-1.0": "CC0-1.0", "GPL-2": "GPL-2.0",
    "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0",
    "GFDL-1.3": "GFDL-1.3", "Artistic": "Artistic-1.0-Perl",
}


def wrapped(text, width):
    """The paragraphs in lines of another width; those with a notice stay as they are."""
    paragraphs = text.split("\n\n")
    return "\n\n".join(
        p if "opyright (" in p or "Copyright" in p else textwrap.fill(p, width) for p in paragraphs
    )


def test_whole_licence_files_match(spark, documents):
    files = {n: Path("/usr/share/common-licenses") / n for n in LICENCE_FILES}
    texts = {n: f.read_text(errors="replace") for n, f in files.items() if f.exists()}
    if not texts:
        pytest.skip("no licence files here")
    rows, wanted = [], {}
    for name, text in texts.items():
        changed = [
            text, text.upper(), text.replace(",", " ;").replace("  ", " "), text.replace("license", "licence"),
            text.replace("\n", "\r\n"), wrapped(text, 100), "\n\n" + text + "\n***\n",
            "Copyright (c) 1999 A Holder\nAll rights reserved.\n\n" + text,
        ]
        for variant in changed:
            wanted[len(rows)] = LICENCE_FILES[name]
            rows.append((len(rows), variant))
        wanted[len(rows)] = None
        rows.append((len(rows), text + "\nNo part of this may be used on Sundays."))
    found = {r["doc_id"]: r["license_id"] for r in licences.scan_licences(documents(rows)).collect()}
    assert found == wanted


def test_titles_appendices_and_list_numbers_are_optional(spark, documents):
    texts = dict(reversed(licences.KNOWN[:7]))
    rows = [
        (1, "MIT License\n\nCopyright (c) 2020 A\n\n" + texts["MIT"]),
        (2, "The MIT License (MIT)\n=====\n" + texts["MIT"]),
        (3, "BSD 3-Clause License\n\nCopyright (c) 2017, B\nAll rights reserved.\n\n" + texts["BSD-3-Clause"]),
        (4, re.sub(r"\d\. ", "* ", texts["BSD-2-Clause"])),
        (5, "Some other title\n" + texts["Zlib"]),
        (6, "MIT License"),
        (7, "zlib License\n\n(C) 1995-2017 C\n\n" + texts["Zlib"]),
        (8, texts["Unlicense"].replace("https", "http")),
    ]
    apache = Path("/usr/share/common-licenses/Apache-2.0")
    if apache.exists():
        rows.append((9, apache.read_text().split("END OF TERMS AND CONDITIONS")[0]))
    out = {r["doc_id"]: r["license_id"] for r in licences.scan_licences(documents(rows)).collect()}
    assert out.pop(9, "Apache-2.0") == "Apache-2.0"
    assert out == {1: "MIT", 2: "MIT", 3: "BSD-3-Clause", 4: "BSD-2-Clause", 5: None, 6: None,
                   7: "Zlib", 8: "Unlicense"}


def test_very_long_texts_and_ties(spark, documents):
    known = [("b", "word " * 50_000), ("a", "Word, " * 50_000), ("c", "other")]
    rows = [(1, "WORD " * 50_000), (2, "word " * 50_001), (3, "other")]
    out = {r["doc_id"]: r["license_id"] for r in licences.scan_licences(documents(rows), known).collect()}
    assert out == {1: "a", 2: None, 3: "c"}
