"""Training-data operators: sharding, packing, deduplication, quality, joins,
tokenization and chat formatting over document tables. Nothing outside this
package imports it; ``queries`` registers one query per operator."""
