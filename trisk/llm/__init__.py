"""Training-data operators: extraction, filtering, deduplication, mixing, tokens.

Each module holds one operator with its own general interface; ``queries`` holds the
thin registered queries over the test tables and their SQL. Nothing outside this
package imports it.
"""
