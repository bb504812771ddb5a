"""Row families: what a (template, seed) pair turns into.

Each module maps jobs(template_id, seed) to rows(template_id, seed, intent,
frame_id, rank1, rank3, rank5, traces). Fixed texts are tables; rows are built
by expressions over the drawn values.
"""
