"""Training-data operators over text and vector tables. Nothing outside this folder imports it."""
