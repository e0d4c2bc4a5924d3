"""DataFrame -> DataFrame operators: reading normaliser, dimension clean-up,
enrichment joins, output records, column profile, dedup, tokens, and the
join / frame helpers they share."""
