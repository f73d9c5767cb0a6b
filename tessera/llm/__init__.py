"""Training-data operators: mixing, packing, chat parsing, fingerprints, page extraction,
near-duplicates, nearest neighbours, language, quality, sharding, periodic runs, line rules and
repair of conversations. Nothing else in the
library imports this subpackage."""
