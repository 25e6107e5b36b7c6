"""The limits, labels and texts that results must carry."""

# Amounts are compared strictly: the first limit below the amount gives the label.
SALARY_GRADES = {"High": 60000, "Medium": 50000}
SALARY_GRADE_ELSE = "Standard"
APPROVALS = {"Critical Review Required": 150000, "Management Approval Needed": 100000}
APPROVAL_ELSE = "Standard Process"

# The middle band includes both of its limits.
BUDGET_BANDS = ("Large", 150000, "Medium", 10000, "Small")
STAFF_BANDS = ("Management", 80000, "Senior", 50000, "Junior")

HIGH_EARNER = 55000
HIGH_BUDGET = 75000
RICH_UNIT = 100000

EMPLOYEE_ORPHAN = "Employee without department"
DEPARTMENT_ORPHAN = "Department without employees"
NO_EMAIL = "No email provided"
UNASSIGNED = "Unassigned"
PROJECT_INFO = "Project: %s - Budget: $%s - Status: %s"
ORDER_STATUSES = ("pending", "processing", "shipped", "delivered", "cancelled")
