"""Markdown made of the orders table, by one expression for Spark and for DuckDB.

Driver tables hold no equations, so each order becomes a document of twelve lines that vary with
its key: labelled and unlabelled blocks, lone delimiters, prose with references, tags, fences.
"""

from __future__ import annotations

B = "chr(92)"
LINE = f"""CASE (o_orderkey * 7 + i * 5 + (o_orderkey % 3) * i) % 18
 WHEN 0 THEN concat('$$x _ {{ ', i, ' }} = k {B}quad ( ', o_orderkey % 9 + 1, ' )$$')
 WHEN 1 THEN 'Prose without any of the signs'
 WHEN 2 THEN concat('As Eq. (', i + 1, ') has it, this holds')
 WHEN 3 THEN '$$'
 WHEN 4 THEN '$$a = b + '
 WHEN 5 THEN 'c - d$$'
 WHEN 6 THEN concat('$$y ^ {{ 2 }} + z = ', o_orderkey % 100, '$$')
 WHEN 7 THEN ''
 WHEN 8 THEN concat('E = m c ^ 2 ( ', i + 1, ' )')
 WHEN 9 THEN concat('$$', {B}, 'begin{{array}} {{ l }} q = k , ( 2 . ', i, ' ) ', {B}, 'end{{array}}$$')
 WHEN 10 THEN 'Smith - Jones ( 2019 )'
 WHEN 11 THEN '```math'
 WHEN 12 THEN concat({B}, 'frac {{ a }} {{ b }} + 1 , ', {B}, 'tag{{', i, 'a}}')
 WHEN 13 THEN concat('(2.', i + 1, ') is the relation between them')
 WHEN 14 THEN '( 7 a )'
 WHEN 15 THEN concat('$$s = t ', {B}, 'quad ( A ', i, ' )$$')
 WHEN 16 THEN concat('  ', {B}, '[ u + v = w ( ', o_orderkey % 5 + 1, '.', i + 1, ' ) ', {B}, ']  ')
 ELSE '```' END""".replace(f"k {B}quad", f"k ', {B}, 'quad")
LINES_DUCK = f"(SELECT o_orderkey AS doc_id, i AS line_no, {LINE} AS text FROM (SELECT o_orderkey, unnest(range(0, 12)) AS i FROM orders))"
#: A real document's text with equations behind it.
REAL_TEXT = f"""concat(text, chr(10), '$$v _ {{ ', doc_id % 5, ' }} = ', n_chars, ' ', {B}, 'quad ( ', doc_id % 9 + 1, ' )$$', chr(10), 'as Eq. (', doc_id % 7 + 10, ') says of ', lang, chr(10), '$$w = 2 ^ {{ ', doc_id % 3, ' }}$$', chr(10), 'E = m ( A', doc_id % 4, ')')"""
