"""A loan-scheme feed: one scheme row, 16 institutes, 14 programs."""

# --- fixed values -----------------------------------------------------------
INSTITUTES = [
    ("SLIIT", "Sri Lanka Institute of Information Technology"),
    ("NSBM", "National School of Business Management"),
    ("CINEC", "CINEC Campus (Pvt) Ltd"),
    ("SIBA", "Sri Lanka Institute of Buddhist Academy"),
    ("ICASL", "Institute of Chartered Accountants of Sri Lanka"),
    ("HORIZON", "Horizon College of Business and Technology (Pvt) Ltd"),
    ("KIU", "KIU Campus (Pvt) Ltd"),
    ("SLTC", "SLT Campus (Pvt) Ltd"),
    ("SAEGIS", "SAEGIS Campus (Pvt) Ltd"),
    ("ESOFT", "ESoft Metro Campus (Pvt) Ltd"),
    ("AQUINAS", "Aquinas College of Higher Studies"),
    ("ICHEM", "Institute of Chemistry Ceylon"),
    ("ICBT", "International College of Business & Technology"),
    ("BCI", "Benedict Catholic Institute of Higher Education"),
    ("NIIBS", "Nagananda International Institute for Buddhist Studies"),
    ("BMS", "Business Management School"),
]
PROGRAMS = [
    ("Humanities and Social Sciences", "800,000"),
    ("Management and Commerce", "900,000"),
    ("Science (Chemical)", "1,200,000"),
    ("Science (Physical)", "1,000,000"),
    ("Engineering", "1,500,000"),
    ("Biotechnology", "1,000,000"),
    ("Engineering Technology", "1,000,000"),
    ("Bachelor of Computer Science", "800,000"),
    ("Bachelor of Science (ICT)", "1,000,000"),
    ("Humanities and Social Sciences (3-year)", "600,000"),
    ("Management and Commerce (3-year)", "600,000"),
    ("Engineering and Technology (3-year)", "800,000"),
    ("Bachelor of Computer Science (3-year)", "600,000"),
    ("Bachelor of Science (ICT, 3-year)", "800,000"),
]
SCHEME = {
    "name": "Interest-Free Student Loan Scheme",
    "description": "Government provides interest-free loan to study degree programs approved by Ministry. "
    "Students may obtain interest-free stipend loan up to Rs. 300,000/- for daily expenses.",
    "eligibility": "\n".join([
        "* Completed G.C.E. (A/L) Examination in 2022, 2023, or 2024",
        "* Obtained simple (S) passes for all three subjects (not exceeding 3 sittings)",
        "* Minimum 30 marks in Common General Test (any sitting, max 3 sittings)",
        "* Minimum simple (S) pass in General English (A/L) or English Language (O/L)",
        "* Age 25 years or below",
        "* Enrolling in approved Degree Awarding Institute (DAI)",
        "* Eligible for government-approved degree programs of high market demand",
        "* Stipend loan up to Rs. 300,000/- available for living expenses",
    ]),
    "funding_amount": "Varies by field (Rs. 600,000 - Rs. 1,500,000)",
    "deadline": "N/A - Ongoing scheme",
    "contact": "Director (Student Loans)",
}
INSTITUTE_TEMPLATES = {
    "name": ("Approved DAI: %s", ["title"]),
    "description": ("Degree Awarding Institute - Code: %s", ["code"]),
}
INSTITUTE_CONSTANTS = {
    "eligibility": "Must be enrolled in this DAI to access the Interest-Free Student Loan Scheme",
    "funding_amount": "Eligible for loan up to Rs. 600,000 - Rs. 1,500,000 (varies by stream)",
    "deadline": "N/A - Ongoing",
    "contact": "Student Loan Scheme",
}
PROGRAM_TEMPLATES = {
    "name": ("Student Loan - %s", ["stream"]),
    "description": ("Interest-Free Student Loan for %s degree programs", ["stream"]),
    "funding_amount": ("Rs. %s/- (Maximum)", ["amount"]),
}
PROGRAM_CONSTANTS = {
    "eligibility": "Must meet A/L requirements and enroll in approved DAI",
    "deadline": "N/A - Ongoing",
    "contact": "Director (Student Loans)",
}
EXPECTED_TYPES = {"Other": 14, "DAI Related": 13, "NSB Loan": 2, "Bank Loan": 1, "Government Loan": 1}
EXPECTED_AMOUNTS = {
    "Rs. 600000": 20, "Rs. 800000": 4, "Rs. 1000000": 4, "Rs. 900000": 1, "Rs. 1200000": 1, "Rs. 1500000": 1,
}
# ----------------------------------------------------------------------------
PLACE = {"application_url": "https://scheme.example.org", "url": "https://scheme.example.org", "source": "Loan Scheme",
         "scrape_date": "2026-01-01T00:00:00"}
