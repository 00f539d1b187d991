"""Operators for preparing large text corpora for language-model training.

Ten operators and the pipeline's building blocks.  Nothing outside this
package imports it; ``registry.py`` lists the queries.

Conventions shared by all of them: a null text counts as the empty text, rows
are never dropped for being long, repeated or tied, columns the operator does
not know are left alone, and an empty table gives an empty result.
"""
