"""Operators for preparing training text: archives, filters, duplicates, models and tokens.

One module per operator; each holds its query and, where SQL can express it, its check.
Nothing outside this folder imports it.
"""
