"""Operators and the pipeline for training data. Nothing else in the library imports this package.

Conventions shared by its modules:

* A word is a run of bytes other than space and 0x09 to 0x0D; only A-Z are lower-cased, where a
  rule asks for it. A NULL text has no words.
* Rows are told apart by what they hold, not by an assumed unique id: repeated rows stay repeated,
  NULL ids are kept and sort last.
* A result column replaces an input column of the same name (without regard to case); other extra
  columns pass through operators that return documents.
* Tables between passes lie in the folder named by ``spark.checkpoint.dir`` (``scratch``).
"""
