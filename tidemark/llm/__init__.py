"""Operators that prepare a text corpus for model training.

Each module holds one operator with its own general interface; ``queries``
registers one query per operator. Nothing outside this folder imports it.
"""
