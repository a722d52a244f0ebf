"""Pages are parsed a few at a time, however many an Arrow batch holds."""

import pyarrow as pa

from postlens.sources import html

PAGE = "<article><h1>The title of page {}</h1><p>Its text.</p></article>"


def test_articles_leave_in_small_parts():
    n = 3 * html.PAGES + 5
    batch = pa.RecordBatch.from_pydict({"page_id": [*range(n)], "url": ["https://a.org/x"] * n, "html": [PAGE.format(i) if i % 4 else None for i in range(n)]})
    seen = []
    parts = html._rows(iter([batch]), lambda root, site: seen.append(site) or html.generic_articles(root, site))
    first = next(parts)
    assert len(seen) <= html.PAGES and first.num_rows == html.PAGES * 3 // 4
    found = [row for part in [first, *parts] for row in part.to_pylist()]
    assert [row["page_id"] for row in found] == [i for i in range(n) if i % 4]
    assert found[0]["title"] == "The title of page 1" and found[0]["source"] == "a.org" and found[0]["author"] is None
