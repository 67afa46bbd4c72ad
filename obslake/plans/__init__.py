"""Job compositions: the raw hour, the silver hour, and the registered
query catalog used by the correctness check and the bench."""
