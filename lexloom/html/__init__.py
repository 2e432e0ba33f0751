"""Understanding of HTML pages: pure functions of (url, html), run in Arrow batches."""
