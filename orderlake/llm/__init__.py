"""Operators for large training-text corpora. Nothing else in the library imports this
package; its queries are added to the entry point only when it can be imported."""
