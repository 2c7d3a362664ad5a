from modelloom.plans.project import Context, Model, ModelRun, Project, only_new, report

__all__ = ["Context", "Model", "ModelRun", "Project", "only_new", "report"]
