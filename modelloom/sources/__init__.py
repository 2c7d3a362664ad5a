from modelloom.sources.declared import Source
from modelloom.sources.relation import RelationName, read_relation, relation_name

__all__ = ["RelationName", "Source", "read_relation", "relation_name"]
