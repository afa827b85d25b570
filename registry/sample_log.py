"""Query strings used by the registered queries, with frequent words of the corpus."""

SAMPLE_LOG = [
    (1, "the"),
    (2, "disgusting"),
    (3, "the AND of"),
    (4, "tion AND NOT the"),
    (5, "lich OR ouen AND elle"),
    (6, "évi tion"),
    (7, 'CADENA("of the")'),
    (8, "PATRON(gust) OR PATRON(o_thon)"),
    (9, "NOT the"),
    (10, "casa de la tion tion"),
    (11, "the AND de"),
    (12, "the NOT of"),
    (13, 'CADENA("and the") AND tion AND NOT PATRON(onth)'),
    (14, "NOT the AND NOT ou OR disgusting"),
    (15, "PATRON(tion) AND eine"),
    (16, "sch ung AND NOT de"),
]

BOOLEAN_QUERIES = {
    "bool_and": [(1, "the AND tion"), (2, "elle AND ouen AND ou"), (3, "the AND absent")],
    "bool_or": [(1, "the OR tion"), (2, "elle lich ung"), (3, "absent OR disgusting")],
    "bool_and_not": [(1, "the AND NOT tion"), (2, "tion AND NOT the AND NOT ou")],
    "bool_not_only": [(1, "NOT the"), (2, "NOT the AND NOT ou"), (3, "NOT absent")],
    "bool_precedence": [(1, "lich OR the AND NOT tion"), (2, "NOT the OR elle AND ou")],
}
