"""Small dump documents for the tests."""

from __future__ import annotations

from xml.sax.saxutils import escape

HEAD = (
    '<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.10/" version="0.10" xml:lang="en">\n'
    "  <siteinfo>\n    <sitename>Test &amp; co</sitename>\n    <dbname>testwiki</dbname>\n"
    "    <base>http://localhost/</base>\n    <generator>hand</generator>\n"
    "    <case>first-letter</case>\n    <namespaces>\n"
    '      <namespace key="0" case="first-letter" />\n'
    '      <namespace key="1" case="case-sensitive">Talk</namespace>\n'
    "    </namespaces>\n  </siteinfo>\n"
)


def revision(id_, ts, text, parent=None, user="registered", minor=False, comment=None):
    contributor = {
        "registered": "<contributor><username>Ann &lt;1&gt;</username><id>7</id></contributor>",
        "ip": "<contributor><ip>10.0.0.1</ip></contributor>",
        "deleted": '<contributor deleted="deleted" />',
    }[user]
    body = (
        '<text deleted="deleted" />'
        if text is None
        else f'<text xml:space="preserve">{escape(text)}</text>'
    )
    return (
        f"    <revision>\n      <id>{id_}</id>\n"
        + (f"      <parentid>{parent}</parentid>\n" if parent else "")
        + f"      <timestamp>{ts}</timestamp>\n      {contributor}\n"
        + ("      <minor />\n" if minor else "")
        + (f"      <comment>{escape(comment)}</comment>\n" if comment else "")
        + "      <model>wikitext</model>\n      <format>text/x-wiki</format>\n"
        + f"      {body}\n      <sha1>x</sha1>\n    </revision>\n"
    )


def page(id_, title, ns, revisions):
    return (
        f"  <page>\n    <title>{escape(title)}</title>\n    <ns>{ns}</ns>\n    <id>{id_}</id>\n"
        + "".join(revisions)
        + "  </page>\n"
    )


def document(pages):
    return HEAD + "".join(pages) + "</mediawiki>\n"


def sample():
    """Three article pages, one of them without revisions, and a talk page."""
    return document(
        [
            page(
                1,
                "First & only",
                0,
                [
                    revision(11, "2015-01-02T00:00:00Z", "  doi=10.1000/x lead\n== References ==\n<ref>b</ref> isbn=1", minor=True),
                    revision(12, "2015-01-01T00:00:00Z", "[[a|b]] </page><page> </revision>\n= S =\n[[c]]", parent=11, user="ip", comment="c > d"),
                    revision(13, "2015-01-03T00:00:00Z", None, parent=12, user="deleted"),
                ],
            ),
            page(2, "Empty", 0, []),
            page(3, "Talk:First", 1, [revision(31, "2015-02-01T00:00:00Z", "[[talk]]")]),
            page(
                4,
                "Long",
                0,
                [
                    revision(
                        400 + n,
                        f"2015-03-01T{n % 24:02d}:{n // 24:02d}:00Z",
                        f"text {n} " + "word " * (n % 7) + f"doi=10.2000/d{n % 3} {{{{x}}}}",
                        parent=399 + n if n else None,
                    )
                    for n in range(60)
                ],
            ),
        ]
    )
