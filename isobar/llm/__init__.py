"""Operators for preparing training corpora: one module per operator.

``queries.py`` registers one ``opN_<name>`` query per operator; nothing else
in the library imports this subpackage.
"""
