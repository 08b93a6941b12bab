"""Other names of canonical entries.

Fixed values, one table for each kind: label, then the names that mean it beside spelling
variants (those are repaired by edit distance). An operator takes them as a parameter.
"""

SKILL_ALIASES = {
    "Python": "py, cpython, python 3, python 3.x",
    "JavaScript": "js, java script, ecmascript, es6",
    "TypeScript": "ts, type script",
    "SQL": "ansi sql, structured query language",
    "PostgreSQL": "pg, psql, postgres, postgre",
    "MongoDB": "mongo, mongo db",
    "Redis": "redis cache, redis db",
    "Amazon Web Services": "aws, amazon aws, aws cloud",
    "Google Cloud": "gcp, g cloud, google cloud platform",
    "Microsoft Azure": "azure, ms azure, azure cloud",
    "Docker": "docker compose, docker containers, dockerisation, dockerization",
    "Kubernetes": "k8s, k8, kube",
    "Machine Learning": "ml, machine learning ml",
    "TensorFlow": "tf, tf2, tensor flow",
    "PyTorch": "torch, py torch",
    "scikit-learn": "sklearn, scikit, sci kit learn",
    "Terraform": "hcl terraform, terra form",
    "Ansible": "ansible playbooks, rh ansible",
    "CI/CD": "ci cd, cicd, continuous integration, continuous delivery",
    "REST APIs": "rest, rest api, restful services, restful api design, restful api",
    "gRPC": "grpc services",
    "Go": "golang, go lang",
    "Java": "java 8, java se, core java",
    "C++": "cpp, c plus plus, c++17",
    "C#": "csharp, c sharp",
    "Rust": "rustlang, rust lang",
    "Git": "git scm, git version control",
    "Linux": "gnu linux, linux admin",
    "Apache Spark": "spark, pyspark, spark 3",
    "Apache Kafka": "kafka, kafka streams",
    "React": "reactjs, react js",
    "Angular": "angular 2+, angularjs, angular js",
    "Node.js": "node, nodejs, node js",
    "Django": "django framework, django rest",
    "Tableau": "tableau desktop",
    "Power BI": "ms power bi, powerbi",
    "Microsoft Excel": "excel, ms excel, adv excel",
    "Project Management": "proj mgmt, project mgmt, managing projects",
    "Data Analysis": "analysing data, data analytics, analyzing data, data analysis skills",
    "Technical Writing": "tech writing, technical author",
    "Customer Service": "cust service, customer care, client service",
    "Copywriting": "copy writing, copywriter skills, copywriter",
    "Forklift Operation": "forklift, fork lift driving, flt licence",
    "Welding": "mig welding, tig weld, arc welding",
    "Bookkeeping": "book keeping",
    "Payroll": "payroll admin, payroll processing",
    "Phlebotomy": "blood draws, phlebotomist cert, phlebotomist",
    "Patient Care": "pt care, caring for patients",
    "Graphic Design": "graphic designer skills, graphics design",
    "Public Speaking": "public speech, presenting in public",
    "Negotiation": "negotiation skills, negotiating",
    "Network Security": "netsec, network sec, net security",
    "Natural Language Processing": "nlp, natural lang processing",
    "Search Engine Optimization": "seo, seo marketing, search engine optimisation",
}

TITLE_ALIASES = {
    "Software Engineer": "swe, software eng, s/w engineer, sw engineer, engineer software",
    "Data Engineer": "data engr",
    "Data Scientist": "data science specialist",
    "Business Analyst": "bus analyst",
    "Product Manager": "prod manager, product mgr, manager of product",
    "Project Manager": "proj manager, project mgr, manager projects",
    "DevOps Engineer": "devops eng, dev ops engr, dev ops engineer",
    "Site Reliability Engineer": "sre",
    "Quality Assurance Engineer": "qa engineer, qa engr, test engineer",
    "Frontend Developer": "front end dev, front end developer, fe developer, frontend dev",
    "Backend Developer": "back end dev, back end developer, be developer, backend dev",
    "Full Stack Developer": "fullstack dev, fullstack developer, fs developer",
    "Mobile Developer": "mobile app dev, mobile dev",
    "Database Administrator": "dba, db admin, database admin",
    "System Administrator": "sysadmin, sys admin, systems administrator",
    "Network Engineer": "network engr",
    "Security Analyst": "sec analyst, infosec analyst",
    "UX Designer": "user experience designer",
    "Graphic Designer": "graphics designer",
    "Technical Writer": "tech writer, technical author",
    "Marketing Manager": "marketing mgr, mktg manager, head of marketing mgmt",
    "Sales Representative": "sales rep",
    "Account Manager": "acct manager, account mgr, acct mgr",
    "Accountant": "acct, acctnt, accountant general",
    "Registered Nurse": "rn, reg nurse",
    "Warehouse Operative": "whse operative, warehouse op",
    "Electrician": "sparky",
    "Customer Service Representative": "csr, cust service rep, customer svc rep, customer service rep",
    "Human Resources Manager": "hr manager, hr mgr, human res manager",
    "Recruitment Consultant": "recruiter, recruitment cons, recruiting consultant",
    "Operations Manager": "ops manager, ops mgr",
    "Executive Assistant": "exec assistant, exec asst, ea to director",
    "Teacher": "tchr, school teacher",
    "Mechanical Engineer": "mech engineer, mech engr",
    "Civil Engineer": "civil engr",
    "Chef": "cook, chef de partie",
    "Pharmacist": "dispensing pharmacist",
}

COUNTRY_ALIASES = {
    "United States": "us, usa, u s a, united states of america, the states, states, america, estados unidos",
    "India": "in, ind, bharat, republic of india",
    "United Kingdom": "uk, gb, gbr, great britain, britain, england",
    "Canada": "ca, can, kanada",
    "Australia": "au, aus",
    "Germany": "de, ger, deu, deutschland, allemagne",
    "France": "fr, fra, frankreich",
    "Singapore": "sg, sgp, s pore",
    "Netherlands": "nl, nld, holland, nederland, the netherlands",
    "Sweden": "se, swe, sverige",
    "Brazil": "br, bra, brasil",
    "China": "cn, chn, prc, p r china",
    "Japan": "jp, jpn, nippon, japon",
    "South Korea": "kr, kor, s korea, korea, republic of korea",
    "Israel": "il, isr",
    "Ireland": "ie, irl, eire, rep of ireland, republic of ireland",
    "Switzerland": "ch, che, suisse, schweiz",
    "New Zealand": "nz, nzl, n zealand, aotearoa",
    "Mexico": "mx, mex",
    "Spain": "es, esp, espana",
    "Italy": "it, ita, italia",
    "Poland": "pl, pol, polska",
    "Ukraine": "ua, ukr, ukraina",
    "Romania": "ro, rou",
    "Portugal": "pt, prt",
    "Pakistan": "pk, pak",
    "Nigeria": "ng, nga",
    "Kenya": "ke, ken",
    "United Arab Emirates": "ae, are, uae, u a e, emirates",
}

# Names near an entry that mean something else; they are ranked with the entries and win as "none".
OTHER_COUNTRIES = ("austria", "niger", "north korea", "iceland", "slovenia", "slovakia", "swaziland", "iran", "iraq", "jordan", "finland", "thailand", "chile", "cuba")

ALIASES = {"skill": SKILL_ALIASES, "title": TITLE_ALIASES, "country": COUNTRY_ALIASES}
OTHERS = {"country": OTHER_COUNTRIES}

# Words that give a level, a duration, a form of contract or a remark; they carry no weight.
REMARK_WORDS = {
    "skill": "basic advanced expert intermediate beginner fluent proficient year years yr yrs of experience exp skills level working knowledge strong good",
    "title": "senior snr sr junior jr lead principal staff interim ii iii iv contract contractor night day shift part full time fulltime parttime permanent temporary freelance intern trainee team the of a secondary primary",
    "country": "remote hybrid onsite the of",
}
