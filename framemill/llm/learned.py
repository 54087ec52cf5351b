"""Rules learned by framemill.llm.training on the documents of the sf0.1 test tables; thresholds as induced."""

RULES = [
    ('table', (('cells_near', '>=', 2.5), ('common', '<', 0.183333), ('length', '>=', 11.5))),
    ('table', (('cells_near', '>=', 2.5), ('common', '<', 0.1), ('cells', '>=', 1.5))),
    ('table', (('cells', '>=', 2.5), ('word_length', '>=', 4.291667))),
    ('table', (('cells', '>=', 2.5), ('digits', '>=', 0.249329))),
    ('junk', (('token', '>=', 21.5), ('cells_near', '<', 3.0))),
    ('junk', (('word_length', '<', 2.912879), ('token', '>=', 7.5), ('length', '>=', 61.5))),
    ('junk', (('same', '>=', 0.5), ('same', '>=', 1.5))),
    ('junk', (('word_length', '>=', 7.527778), ('token', '>=', 9.5))),
    ('junk', (('distinct', '<', 0.754133), ('distinct', '<', 0.509494))),
    ('junk', (('mixed', '>=', 0.06), ('length', '>=', 11.5))),
    ('junk', (('token', '>=', 13.5), ('common', '<', 0.1))),
    ('junk', (('same', '>=', 0.5), ('longest_near', '<', 11.0))),
    ('junk', (('mixed', '>=', 0.162338), ('letters', '>=', 0.809091))),
    ('junk', (('common', '<', 0.264912), ('length', '>=', 47.5), ('common', '<', 0.133929), ('commas', '<', 0.5))),
    ('list', (('length', '<', 41.5), ('longest_near', '<', 45.5), ('marked', '>=', 0.5))),
    ('list', (('words', '<', 6.5), ('longest_near', '<', 45.0), ('length', '<', 22.5))),
    ('list', (('words', '<', 7.5), ('marked', '>=', 0.5))),
    ('list', (('length', '<', 39.5), ('longest_near', '<', 48.5), ('length', '<', 30.5))),
    ('list', (('marked', '>=', 0.5), ('marked_near', '>=', 0.5))),
    ('list', (('cells', '>=', 2.5), ('longest_near', '<', 49.0))),
    ('list', (('length', '<', 39.5), ('longest_near', '<', 49.5), ('length', '<', 35.5))),
]
