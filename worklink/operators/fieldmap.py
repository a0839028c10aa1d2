"""Which JSON path feeds which column (PRJ-01..PRJ-04).

A row holds a column, its kind and its paths; of several paths the first truthy one counts. A path starts
with the column of the table that holds the document (a path of one step is that column itself) and
goes on with the keys of nested objects. Columns come out in the order of the rows.

Kinds: text, raw (a loosely typed scalar kept as text), phone, bool, list (joined by '|'), elements
(every element as text, joined), json, name (an object's name or the scalar), given (text of a truthy
value).
"""

from __future__ import annotations

from dataclasses import dataclass

# fixed values: column names and JSON paths of the published data model

PROFILE = [
    ("name", "text", ["metadata.name", "metadata.whoIAm.name"]),
    ("role", "text", ["metadata.role"]),
    ("gender", "text", ["metadata.gender", "metadata.whoIAm.gender"]),
    ("age", "raw", ["metadata.age", "metadata.whoIAm.age", "metadata.whatIHave.age"]),
    ("industry", "text", ["metadata.industry"]),
    ("phone", "phone", ["metadata.whoIAm.phone"]),
    ("date_of_birth", "text", ["metadata.whoIAm.dateOfBirth"]),
    ("hometown", "text", ["metadata.whoIAm.hometown"]),
    ("current_location", "text", ["metadata.whoIAm.currentLocation", "metadata.whoIAm.location"]),
    ("desired_location", "text", ["metadata.whoIAm.desiredLocation"]),
    ("father_name", "text", ["metadata.whoIAm.fatherName"]),
    ("mother_name", "text", ["metadata.whoIAm.motherName"]),
    ("aadhar_number", "text", ["metadata.whoIAm.aadharNumber"]),
    ("location_city", "text", ["metadata.whoIAm.locationData.city"]),
    ("location_state", "text", ["metadata.whoIAm.locationData.state"]),
    ("location_address", "text", ["metadata.whoIAm.locationData.address"]),
    ("location_country", "text", ["metadata.whoIAm.locationData.country"]),
    ("is_age_verified", "bool", ["metadata.whoIAm.isAgeVerified"]),
    ("is_name_verified", "bool", ["metadata.whoIAm.isNameVerified"]),
    ("is_phone_verified", "bool", ["metadata.whoIAm.isPhoneVerified"]),
    ("is_location_verified", "bool", ["metadata.whoIAm.isLocationVerified"]),
    ("roll_number", "text", ["metadata.whatIHave.rollNumber"]),
    ("iti_institute", "text", ["metadata.whatIHave.itiInstitute"]),
    ("iti_specialization", "list", ["metadata.whatIHave.itiSpecialization"]),
    ("training_duration_years", "raw", ["metadata.whatIHave.trainingDuration"]),
    ("highest_qualification", "list", ["metadata.whatIHave.highestQualification"]),
    ("language_spoken", "list", ["metadata.whatIHave.languageSpoken"]),
    ("machines_operated", "list", ["metadata.whatIHave.machinesOperated"]),
    ("previous_company", "text", ["metadata.whatIHave.previousCompany"]),
    ("previous_location", "given", ["metadata.whatIHave.previousLocation"]),
    ("current_monthly_salary", "raw", ["metadata.whatIHave.currentMonthlySalary"]),
    ("total_years_experience", "raw", ["metadata.whatIHave.totalYearsOfExperience"]),
    ("fitter_assessment_score", "raw", ["metadata.whatIHave.fitterAssessmentScore"]),
    ("intent_assessment_score", "raw", ["metadata.whatIHave.intentAssessmentScore"]),
    ("preferred_mode_of_work", "list", ["metadata.whatIWant.preferredModeOfWork"]),
    ("monthly_in_hand_preferred", "raw", ["metadata.whatIWant.monthlyInHandPreferred"]),
    ("monthly_ot_expectation", "raw", ["metadata.whatIWant.monthlyOTExpectation"]),
    ("monthly_pf_esic", "text", ["metadata.whatIWant.monthlyPFESIC"]),
    ("work_hours_per_day", "raw", ["metadata.whatIWant.workHoursPerDay", "metadata.workHoursPerDay"]),
    ("education", "elements", ["metadata.education"]),
    ("status", "text", ["metadata.status"]),
    ("source", "text", ["metadata.source"]),
    ("agent_id", "text", ["metadata.agentId"]),
    ("is_aadhar_verified", "bool", ["metadata.isAadharVerified"]),
    ("is_gender_verified", "bool", ["metadata.isGenderVerified"]),
    ("is_hometown_verified", "bool", ["metadata.isHometownVerified"]),
    ("location_lat", "raw", ["metadata.whoIAm.locationData.lat"]),
    ("location_lng", "raw", ["metadata.whoIAm.locationData.lng"]),
    ("work_experience", "text", ["metadata.whatIHave.workExperience"]),
    ("work_experience_years", "raw", ["metadata.whatIHave.workExperienceYears"]),
    ("vehicle_ownership", "text", ["metadata.whatIHave.vehicleOwnership"]),
    ("communication_skills_score", "raw", ["metadata.whatIHave.communicationSkillsScore"]),
    ("domain_knowledge", "text", ["metadata.whatIHave.domainKnowledge"]),
    ("software_skills", "list", ["metadata.whatIHave.softwareSkills"]),
    ("languages_known", "list", ["metadata.whatIHave.languagesKnown"]),
    ("highest_qualification_or_skill", "text", ["metadata.whatIHave.highestQualificationOrSkill"]),
    ("highest_education", "text", ["metadata.whatIHave.highestEducation"]),
    ("highest_educational_institute_attended", "text", ["metadata.whatIHave.highestEducationalInstituteAttended"]),
    ("name_of_last_role_held", "text", ["metadata.whatIHave.nameOfLastRoleHeld"]),
    ("juki_machine_experience", "text", ["metadata.whatIHave.jukiMachineExperience"]),
    ("juki_machine_straight_line", "text", ["metadata.whatIHave.jukiMachineStraightLine"]),
    ("consent_physical_health", "bool", ["metadata.whatIHave.consent for physical health"]),
    ("consent_safety_requirements", "bool", ["metadata.whatIHave.consent for safety requirements"]),
    ("quality_proof_image", "text", ["metadata.whatIHave.qualityProofImage"]),
    ("skill_proof_video", "text", ["metadata.whatIHave.skillProofVideo"]),
    ("task_video", "text", ["metadata.whatIHave.taskVideo"]),
    ("monthly_travel_allowance", "raw", ["metadata.whatIWant.monthlyTravelAllowance"]),
    ("monthly_performance_variable", "raw", ["metadata.whatIWant.monthlyPerformanceVariable"]),
    ("monthly_pf_health_insurance", "raw", ["metadata.whatIWant.monthlyPFHealthInsurance"]),
    ("interested_job_roles", "list", ["metadata.whatIWant.nameOfJobRolesInterestedIn"]),
    ("nature_of_jobs_interested", "list", ["metadata.whatIWant.natureOfJobsInterestedIn"]),
    ("preferred_work_mode", "text", ["metadata.whatIWant.preferredWorkMode"]),
    ("stay_preferences", "list", ["metadata.whatIWant.stayPreferences"]),
    ("max_distance_daily_travel", "raw", ["metadata.whatIWant.maxDistanceofDailyTravel"]),
    ("max_cost_per_sharing_bed", "raw", ["metadata.whatIWant.maxCostPerSharingBed"]),
    ("other_help_needed", "text", ["metadata.whatIWant.otherHelpNeeded"]),
    ("iti_institute_slug", "text", ["metadata.whatIHave.itiInstituteSlug"]),
    ("assessment_scores", "json", ["metadata.whatIHave.assessmentScores"]),
    ("document_verification_status", "json", ["metadata.whatIHave.documentVerificationStatus"]),
    ("college_name", "text", ["metadata.whatIHave.collegeName"]),
    ("highest_educational_qualification", "text", ["metadata.whatIHave.highestEducationalQualification"]),
    ("highest_qualification_other", "text", ["metadata.whatIHave.highestQualification_other"]),
    ("electrician_assessment_score", "raw", ["metadata.whatIHave.electricianAssessmentScore"]),
    ("machine_operator_assessment_score", "raw", ["metadata.whatIHave.machineOperatorAssessmentScore"]),
    ("mechanic_assessment_score", "raw", ["metadata.whatIHave.mechanicAssessmentScore"]),
    ("hr_knowledge", "raw", ["metadata.whatIHave.hrKnowledge"]),
    ("hr_work_experience", "raw", ["metadata.whatIHave.hrWorkExperience"]),
    ("warehouse_experience", "raw", ["metadata.whatIHave.warehouseExperience"]),
    ("presentability_score", "raw", ["metadata.whatIHave.presentabilityScore"]),
    ("skills", "list", ["metadata.skills"]),
    ("skill_certifications", "list", ["metadata.skillCertifications"]),
    ("certificates", "list", ["metadata.certificates"]),
    ("gen2_experience", "text", ["metadata.experience"]),
    ("notes", "text", ["metadata.notes"]),
]

ORGANIZATION = [
    ("address", "text", ["metadata.address"]),
    ("gst_number", "text", ["metadata.gstNumber"]),
    ("contact_person", "text", ["metadata.contactPersonName"]),
    ("contact_email", "text", ["metadata.contactEmail"]),
    ("contact_phone", "phone", ["metadata.contactPhone"]),
    ("website", "text", ["metadata.website"]),
    ("description", "text", ["metadata.description"]),
]

JOB_POSTING = [
    ("role", "text", ["metadata.role", "metadata.jobRole", "metadata.job_role", "metadata.jobDetails.title", "metadata.jobDetails.jobTitle", "title"]),
    ("industry", "text", ["metadata.industry", "metadata.sector", "metadata.jobSector", "metadata.industrySector"]),
    ("provider_location_city", "text", ["metadata.basicInfo.jobProviderLocation.city", "metadata.basicInfo.jobProviderLocation.tag"]),
    ("provider_location_state", "text", ["metadata.basicInfo.jobProviderLocation.state"]),
    ("provider_location_address", "text", ["metadata.basicInfo.jobProviderLocation.address"]),
    ("provider_location_country", "text", ["metadata.basicInfo.jobProviderLocation.country"]),
    ("provider_location_lat", "raw", ["metadata.basicInfo.jobProviderLocation.gps.lat"]),
    ("provider_location_lng", "raw", ["metadata.basicInfo.jobProviderLocation.gps.lng"]),
    ("job_type", "list", ["metadata.jobDetails.jobType"]),
    ("positions", "raw", ["metadata.jobDetails.positions", "metadata.jobDetails.openings", "metadata.jobDetails.numberOfOpenings", "metadata.jobDetails.noOfOpenings", "metadata.jobDetails.vacancies"]),
    ("mode_of_work", "list", ["metadata.jobDetails.modeOfWork"]),
    ("food_provided", "text", ["metadata.jobDetails.foodProvided"]),
    ("travel_provided", "text", ["metadata.jobDetails.travelProvided"]),
    ("stay_provided", "text", ["metadata.jobDetails.stayProvided"]),
    ("job_description", "text", ["metadata.jobDetails.jobDescription", "metadata.jobDetails.description", "metadata.jobDetails.jobDesc", "description"]),
    ("min_monthly_in_hand", "raw", ["metadata.jobDetails.minMonthlyInHand", "metadata.jobDetails.minSalary", "metadata.jobDetails.salaryMin", "metadata.jobDetails.minCTC"]),
    ("max_monthly_in_hand", "raw", ["metadata.jobDetails.maxMonthlyInHand", "metadata.jobDetails.maxSalary", "metadata.jobDetails.salaryMax", "metadata.jobDetails.maxCTC"]),
    ("working_hours_per_day", "raw", ["metadata.jobDetails.workingHoursPerDay"]),
    ("hiring_urgency", "text", ["metadata.jobDetails.hiringUrgency"]),
    ("hiring_manager_name", "text", ["metadata.jobDetails.hiringManagerName"]),
    ("hiring_manager_designation", "text", ["metadata.jobDetails.hiringManagerDesignation"]),
    ("gender_preference", "text", ["metadata.jobNeeds.genderPreference"]),
    ("age_lower_limit", "raw", ["metadata.jobNeeds.ageAllowedLowerLimit"]),
    ("age_upper_limit", "raw", ["metadata.jobNeeds.ageAllowedUpperLimit"]),
    ("min_education_level", "list", ["metadata.jobNeeds.educationSubsection.minEducationLevel"]),
    ("iti_specialty_preference", "list", ["metadata.jobNeeds.educationSubsection.itiSpecialtyPreference"]),
    ("languages_required", "list", ["metadata.jobNeeds.languagesSubsection.languagesKnown"]),
    ("job_title", "text", ["metadata.jobDetails.title", "title"]),
    ("org_name", "text", ["metadata.org_name"]),
    ("org_slug", "text", ["metadata.org_slug"]),
    ("is_duplicate", "bool", ["metadata.isDuplicate"]),
    ("agent_id", "text", ["metadata.agentId"]),
    ("agent_title", "text", ["metadata.agentTitle"]),
    ("job_provider_name", "text", ["metadata.basicInfo.jobProviderName"]),
    ("job_provider_type", "text", ["metadata.basicInfo.jobProviderType"]),
    ("hiring_manager_email", "text", ["metadata.basicInfo.hiringManagerEmail"]),
    ("hiring_manager_phone", "phone", ["metadata.basicInfo.hiringManagerPhoneNumber"]),
    ("nature_of_job", "text", ["metadata.jobDetails.natureOfJob"]),
    ("monthly_attendance_bonus", "raw", ["metadata.jobDetails.monthlyAttendanceBonus"]),
    ("monthly_attendance_bonus_criteria", "text", ["metadata.jobDetails.monthlyAttendanceBonusCriteria"]),
    ("monthly_travelling_allowance", "raw", ["metadata.jobDetails.monthlyTravellingAllowance"]),
    ("monthly_average_ot", "raw", ["metadata.jobDetails.monthlyAverageOT", "metadata.jobDetails.monthlyAverageOt"]),
    ("monthly_incentive_possible", "raw", ["metadata.jobDetails.monthlyIncentivePossible"]),
    ("monthly_max_performance_variable", "raw", ["metadata.jobDetails.monthlyMaxPerformanceBasedVariable"]),
    ("monthly_pf_esic_benefits", "raw", ["metadata.jobDetails.monthlyPfEsicBenefits"]),
    ("ot_per_hour_rate", "raw", ["metadata.jobDetails.otPerHourRate"]),
    ("daily_travel_required", "text", ["metadata.jobDetails.dailyTravelRequired"]),
    ("valid_till", "text", ["metadata.jobDetails.validTill"]),
    ("stipend_min", "raw", ["metadata.jobDetails.stipendMin"]),
    ("stipend_max", "raw", ["metadata.jobDetails.stipendMax"]),
    ("salary_min", "raw", ["metadata.jobDetails.salaryMin"]),
    ("salary_max", "raw", ["metadata.jobDetails.salaryMax"]),
    ("task_rate_min", "raw", ["metadata.jobDetails.taskRateMin"]),
    ("task_rate_max", "raw", ["metadata.jobDetails.taskRateMax"]),
    ("callback_time", "text", ["metadata.jobDetails.callBackTime"]),
    ("work_experience_years_required", "raw", ["metadata.jobNeeds.workExperienceYears"]),
    ("candidate_experience_type", "text", ["metadata.jobNeeds.candidateExperienceType"]),
    ("last_role_held", "text", ["metadata.jobNeeds.lastRoleHeld"]),
    ("vehicle_ownership_required", "text", ["metadata.jobNeeds.vehicleOwnershipRequirement", "metadata.jobNeeds.customerHandlingSubsection.vehicleOwnershipRequirement"]),
    ("highest_qualification_accepted", "list", ["metadata.jobNeeds.highestQualificationAccepted", "metadata.jobNeeds.highestQualificationSubsection.highestQualification"]),
    ("location_preference_city", "text", ["metadata.jobNeeds.locationPreference.city", "metadata.jobNeeds.locationPreference.tag"]),
    ("location_preference_state", "text", ["metadata.jobNeeds.locationPreference.state"]),
    ("location_preference_address", "text", ["metadata.jobNeeds.locationPreference.address"]),
    ("location_preference_country", "text", ["metadata.jobNeeds.locationPreference.country"]),
    ("location_preference_lat", "raw", ["metadata.jobNeeds.locationPreference.gps.lat"]),
    ("location_preference_lng", "raw", ["metadata.jobNeeds.locationPreference.gps.lng"]),
    ("job_provider_logo", "text", ["metadata.basicInfo.jobProviderLogo"]),
    ("job_provider_registration", "text", ["metadata.basicInfo.jobProviderRegistration"]),
    ("designation", "text", ["metadata.jobDetails.designation"]),
    ("devices_provided", "list", ["metadata.jobDetails.devicesProvided"]),
    ("start_time", "text", ["metadata.jobDetails.startTime"]),
    ("end_time", "text", ["metadata.jobDetails.endTime"]),
    ("original_job_id", "text", ["metadata.originalJobId"]),
    ("communication_subsection", "json", ["metadata.jobNeeds.communicationSubsection"]),
    ("domain_knowledge_subsection", "json", ["metadata.jobNeeds.domainKnowledgeSubsection"]),
    ("hr_knowledge_subsection", "json", ["metadata.jobNeeds.hrKnowledgeSubsection"]),
    ("hr_work_experience_subsection", "json", ["metadata.jobNeeds.hrWorkExperienceSubsection"]),
    ("juki_machine_straight_line_subsection", "json", ["metadata.jobNeeds.jukiMachineStraightLineSubsection"]),
    ("physical_fitness_subsection", "json", ["metadata.jobNeeds.physicalFitnessSubsection"]),
    ("physical_health_requirements", "json", ["metadata.jobNeeds.physicalHealthRequirements"]),
    ("ppe_ready_safety_compliance", "json", ["metadata.jobNeeds.ppeReadySafetyCompliance"]),
    ("educational_qualification_subsection", "json", ["metadata.jobNeeds.educationalQualificationSubsection"]),
    ("skills_required", "list", ["metadata.jobNeeds.educationSubsection.skillsRequired"]),
    ("software_knowledge_preferred", "text", ["metadata.jobNeeds.highestQualificationSubsection.softwareKnowledgePreferred"]),
    ("communication_skill_score_required", "raw", ["metadata.jobNeeds.communicationSkillScore"]),
]

JOB_APPLICATION = [
    ("seeker_name", "text", ["user_name", "metadata.name"]),
    ("seeker_phone", "phone", ["contact.phone", "metadata.metadata.whoIAm.phone"]),
    ("seeker_email", "text", ["contact.email"]),
    ("seeker_age", "raw", ["metadata.age", "metadata.metadata.age"]),
    ("seeker_gender", "text", ["metadata.gender", "metadata.metadata.whoIAm.gender"]),
    ("app_location_city", "name", ["location.city"]),
    ("app_location_state", "name", ["location.state"]),
    ("app_location_address", "text", ["location.address"]),
    ("app_location_country", "text", ["location.country"]),
    ("seeker_current_location", "text", ["metadata.metadata.whoIAm.location", "metadata.metadata.whoIAm.currentLocation"]),
    ("seeker_iti_institute", "text", ["metadata.metadata.whatIHave.itiInstitute"]),
    ("seeker_iti_specialization", "list", ["metadata.metadata.whatIHave.itiSpecialization"]),
    ("seeker_highest_qualification", "list", ["metadata.metadata.whatIHave.highestQualification"]),
    ("seeker_language_spoken", "list", ["metadata.metadata.whatIHave.languageSpoken"]),
    ("seeker_roll_number", "text", ["metadata.metadata.whatIHave.rollNumber"]),
    ("seeker_total_experience", "raw", ["metadata.metadata.whatIHave.totalYearsOfExperience"]),
    ("seeker_expected_salary", "raw", ["metadata.metadata.whatIWant.monthlyInHandPreferred"]),
    ("seeker_preferred_mode", "list", ["metadata.metadata.whatIWant.preferredModeOfWork"]),
    ("job_title", "text", ["metadata.jobDetails.title", "metadata.jobDetails.jobTitle", "metadata.jobDetails.jobDetails.title", "metadata.metadata.interestedRole"]),
    ("job_role", "text", ["metadata.jobDetails.role", "metadata.metadata.interestedRole"]),
    ("job_industry", "text", ["metadata.jobDetails.industry", "metadata.metadata.interestedIndustry"]),
    ("job_company", "text", ["metadata.jobDetails.company", "metadata.jobDetails.jobProviderName"]),
    ("job_location", "given", ["metadata.jobDetails.location"]),
    ("job_openings", "raw", ["metadata.jobDetails.openings", "metadata.jobDetails.positions", "metadata.jobDetails.jobDetails.positions"]),
    ("job_min_salary", "raw", ["metadata.jobDetails.monthlyInHand", "metadata.jobDetails.jobDetails.minMonthlyInHand"]),
    ("job_max_salary", "raw", ["metadata.jobDetails.jobDetails.maxMonthlyInHand"]),
    ("match_score", "raw", ["metadata.jobDetails.matchScore"]),
    ("job_provider_name", "text", ["metadata.jobDetails.jobProviderName", "metadata.jobDetails.basicInfo.jobProviderName"]),
    ("job_hiring_manager", "text", ["metadata.jobDetails.jobDetails.hiringManagerName"]),
    ("job_nature", "text", ["metadata.jobDetails.jobDetails.natureOfJob"]),
    ("job_min_monthly_ot", "raw", ["metadata.jobDetails.jobDetails.monthlyAverageOT"]),
    ("job_valid_till", "text", ["metadata.jobDetails.jobDetails.validTill"]),
    ("app_location_lat", "raw", ["location.gps.lat"]),
    ("app_location_lng", "raw", ["location.gps.lng"]),
    ("seeker_interested_role", "text", ["metadata.interestedRole", "metadata.metadata.interestedRole"]),
    ("seeker_interested_industry", "text", ["metadata.interestedIndustry", "metadata.metadata.interestedIndustry"]),
    ("seeker_is_age_verified", "bool", ["metadata.isAgeVerified"]),
    ("seeker_is_aadhar_verified", "bool", ["metadata.isAadharVerified"]),
    ("seeker_is_name_verified", "bool", ["metadata.isNameVerified"]),
    ("seeker_is_hometown_verified", "bool", ["metadata.isHometownVerified"]),
    ("seeker_is_gender_verified", "bool", ["metadata.isGenderVerified"]),
    ("seeker_work_experience", "text", ["metadata.metadata.whatIHave.workExperience"]),
    ("seeker_work_experience_years", "raw", ["metadata.metadata.whatIHave.workExperienceYears"]),
    ("seeker_vehicle_ownership", "text", ["metadata.metadata.whatIHave.vehicleOwnership"]),
    ("seeker_communication_skills_score", "raw", ["metadata.metadata.whatIHave.communicationSkillsScore"]),
    ("seeker_domain_knowledge", "text", ["metadata.metadata.whatIHave.domainKnowledge"]),
    ("seeker_software_skills", "list", ["metadata.metadata.whatIHave.softwareSkills"]),
    ("seeker_monthly_travel_allowance", "raw", ["metadata.metadata.whatIWant.monthlyTravelAllowance"]),
    ("seeker_monthly_performance_variable", "raw", ["metadata.metadata.whatIWant.monthlyPerformanceVariable"]),
    ("seeker_preferred_work_mode", "text", ["metadata.metadata.whatIWant.preferredWorkMode"]),
    ("seeker_stay_preferences", "list", ["metadata.metadata.whatIWant.stayPreferences"]),
    ("seeker_max_cost_per_sharing_bed", "raw", ["metadata.metadata.whatIWant.maxCostPerSharingBed"]),
    ("seeker_profile_id", "text", ["metadata.profileId"]),
    ("seeker_skills", "list", ["metadata.skills"]),
    ("seeker_skill_certifications", "list", ["metadata.skillCertifications"]),
    ("seeker_certificates", "list", ["metadata.certificates"]),
    ("seeker_assessment_scores", "json", ["metadata.assessmentScores"]),
    ("seeker_education", "elements", ["metadata.education"]),
]


@dataclass(frozen=True)
class Path:
    root: str  # 'metadata' or the name of a table column
    keys: tuple[str, ...]  # () is the column itself, as plain text


@dataclass(frozen=True)
class Field:
    column: str
    kind: str
    paths: tuple[Path, ...]


def path(text: str) -> Path:
    root, *keys = text.split(".")
    return Path(root, tuple(keys))


def fields(rows: list[tuple[str, str, list[str]]]) -> tuple[Field, ...]:
    return tuple(Field(column, kind, tuple(path(p) for p in paths)) for column, kind, paths in rows)


FIELD_MAPS = {
    "profile": fields(PROFILE),
    "organization": fields(ORGANIZATION),
    "job_posting": fields(JOB_POSTING),
    "job_application": fields(JOB_APPLICATION),
}
