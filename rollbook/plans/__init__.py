from rollbook.plans.cohorts import active_as_of, new_users, new_users_between, total_users
from rollbook.plans.copies import copy_dataset

__all__ = ["active_as_of", "copy_dataset", "new_users", "new_users_between", "total_users"]
