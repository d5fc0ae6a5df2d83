"""Operators for building language-model training data.

Nothing else in the library imports this subpackage.  One module per
operator; :mod:`strata.llm.queries` registers one query per operator.
"""
