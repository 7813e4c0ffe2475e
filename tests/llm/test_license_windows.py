"""Notices spread over many lines, at every start offset of the windows of lines."""

from monthclose.llm import license_scan


def test_notices_over_many_lines(spark):
    rows, want = [], {}
    for label, text in license_scan.TEMPLATES:
        words = text.split()
        for n in range(6, 41):
            for offset in range(4):
                cuts = [len(words) * k // n for k in range(n + 1)]
                notice = ["# " + " ".join(words[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
                i = len(rows)
                rows.append((i, "\n".join(["before it"] * offset + notice + ["after it"] * 3)))
                want[i] = label
    found = license_scan.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(found) == len(rows)
    assert [r.doc_id for r in found if want[r.doc_id] not in r.labels or r.score < 1] == []


def test_scattered_words_are_no_notice(spark):
    text = "\n".join(f"{w} " + "other " * 40 for w in "released under the mit text license".split())
    found = license_scan.scan(spark.createDataFrame([(1, "\n\n\n\n\n".join(text.split("\n")))], "doc_id long, text string"))
    assert found.first().labels == []
