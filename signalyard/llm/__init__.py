"""Operators for preparing training corpora (packing, token files, secret
scans, fixity audits, toxicity, mixing, de-duplication, fingerprints).

Nothing else in the library imports this subpackage."""
