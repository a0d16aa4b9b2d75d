"""The registered corpus queries and the SQL of those that SQL can express."""

import corpus_pipeline
from palate.llm.alignment import op12_alignment
from palate.llm.bpe import op2_bpe
from palate.llm.decontamination import OP13_SQL, op13_decontamination
from palate.llm.importance import op11_importance
from palate.llm.mixing import OP4_SQL, op4_mixing
from palate.llm.neighbors import op3_neighbors
from palate.llm.quality_classifier import op10_quality_classifier
from palate.llm.quality_rules import OP6_SQL, op6_quality_rules
from palate.llm.sharding import op9_sharding
from palate.llm.simhash import op7_simhash
from palate.llm.token_counts import op1_token_counts
from palate.llm.url_filters import OP5_SQL, op5_url_filters
from palate.llm.warc import OP8_SQL, op8_warc

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_token_counts": op1_token_counts,
    "op2_bpe": op2_bpe,
    "op3_neighbors": op3_neighbors,
    "op4_mixing": op4_mixing,
    "op5_url_filters": op5_url_filters,
    "op6_quality_rules": op6_quality_rules,
    "op7_simhash": op7_simhash,
    "op8_warc": op8_warc,
    "op9_sharding": op9_sharding,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_importance": op11_importance,
    "op12_alignment": op12_alignment,
    "op13_decontamination": op13_decontamination,
}
ORACLES = {
    "op4_mixing": OP4_SQL,
    "op5_url_filters": OP5_SQL,
    "op6_quality_rules": OP6_SQL,
    "op8_warc": OP8_SQL,
    "op13_decontamination": OP13_SQL,
}
