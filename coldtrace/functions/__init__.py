"""Column-returning functions: payload decoding, rule judgement, texts, draws."""
