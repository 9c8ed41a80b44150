"""Header places are looked up once a document, below the rows, and the right-most header of a name wins."""

from tidemark.sources.landed import calendar_rows


def test_places_are_found_once_a_document(spark):
    html = ("<table><tr><th>Event</th><th>Date</th><th>Actual</th><th>Previous</th><th>Actual</th></tr>"
            "<tr><td>Jobs</td><td>2024-01-05</td><td>1</td><td>2</td><td>3</td></tr><tr><td>Rate</td><td>2024-01-06</td><td>4</td><td>5</td></tr></table>")
    out = calendar_rows(spark.createDataFrame([(html, "u"), ("<p>none</p>", "v")], "html string, source_url string"))
    got = sorted((r.event, r.event_time, r.actual, r.previous, r.symbol, r.country) for r in out.collect())
    assert got == [("Jobs", "2024-01-05", "3", "2", "", "United States"), ("Rate", "2024-01-06", "", "5", "", "United States")]
    above = out._jdf.queryExecution().optimizedPlan().toString().split("Generate")[0]
    assert "array_position" not in above
