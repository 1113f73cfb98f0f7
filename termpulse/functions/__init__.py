"""Column-level building blocks: text, URLs, HTML, dates, article fields, replies."""
