"""Outputs: CSV with a byte-order mark, workbooks, HTML and Markdown reports, ledgers, snapshots."""
