"""Places and shapes of tables that several test modules use."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = "/root/testdata/sf0.001"
