"""DataFrame operators whose semantics a single built-in call does not give."""
