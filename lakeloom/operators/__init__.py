"""Relational operators on triples, seed tables and the lake. DataFrame in, DataFrame out."""
