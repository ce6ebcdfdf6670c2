"""Operators for preparing language-model training data.

One module per operator, each with a general interface (`DataFrame ->
DataFrame`, column names as arguments); `queries` binds them to the tables of
a data folder.  Nothing outside this subpackage imports it.
"""
